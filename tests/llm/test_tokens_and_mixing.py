"""Token counts, token files, packing, mixing and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from barlake.llm import exact_dedup, mixing, packing, quality, token_counts, token_files, tokens
from tests.llm.test_dedup import exact_brute, near_brute

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def _ids(tokenizer: Tokenizer, text: str | None) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file,spaces", [(BYTE, True), (WORD, False)])
def test_cached_encoding_is_that_of_whole_texts(cases, file, spaces):
    rnd = random.Random(2)
    odd = ["".join(rnd.choice("ab 'S12.\n é\t<|>ß") for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    own, whole = tokens.Encoder(file, spaces, limit=50), Tokenizer.from_file(file)
    offsets = tokens.OffsetEncoder(file, limit=50)
    for text in [*odd, *(t or "" for _, t, _ in cases)]:
        there = whole.encode(text, add_special_tokens=False)
        assert own.ids(text) == np.array(there.ids, "<u4").tobytes()
        if spaces:
            assert [tuple(x) for x in offsets.spans(text).tolist()] == there.offsets


def test_section_tokens(docs, cases, empty):
    whole, by, rows = Tokenizer.from_file(BYTE), defaultdict(int), token_counts.section_tokens(docs, BYTE).collect()
    for r in rows:
        by[str(r.doc_id)] += r.n_tokens
    want = defaultdict(int)
    for i, t, _ in cases:
        want[str(i)] += len(_ids(whole, t))
    assert by == want
    assert token_counts.section_tokens(empty, BYTE).count() == 0


def test_tokens_across_a_boundary_go_to_the_larger_share():
    spans = np.array([[0, 3], [3, 8], [8, 10], [10, 14]])
    counted, crossing = token_counts.attribute(spans, np.array([0, 4, 9, 12]), 14)
    # [3, 8) has 1 and 4 characters, [8, 10) and [10, 14) two equal shares: the earlier section
    assert counted.tolist() == [1, 2, 1, 0] and crossing.tolist() == [0, 2, 1, 0]


@pytest.mark.parametrize("block", [7, token_files.BLOCK])
def test_token_files(spark, docs, cases, empty, tmp_path, block):
    path, whole = str(tmp_path / "tokens"), Tokenizer.from_file(WORD)
    token_files.write_tokens(docs, path, WORD, end_id=1, spaces=False, block=block)
    ordered = sorted(cases, key=lambda c: (c[0] is not None, c[0] or 0, c[1] or ""))
    start, want, stream = 0, [], []
    for i, t, _ in ordered:
        ids = [*_ids(whole, t), 1]
        want.append((str(i), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        stream.append(ids)
    got = token_files.read_documents(spark, path).collect()
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    parts = defaultdict(list)
    for r in token_files.read_ids(spark, path).collect():
        parts[r.doc_id].append((r.offset, r.ids))
    assert [x for _, ids in sorted(parts[1]) for x in ids] == stream[[c[0] for c in ordered].index(1)]
    nothing = str(tmp_path / "nothing")
    token_files.write_tokens(empty, nothing, WORD, end_id=1, spaces=False)
    assert token_files.read_documents(spark, nothing).count() == 0


def test_planes_and_partial_checksums():
    rnd = np.random.default_rng(1)
    ids = rnd.integers(0, 2**32, 1000, dtype=np.uint64).astype("<u4").tobytes()
    assert token_files.from_planes(token_files.to_planes(ids, zstandard.ZstdCompressor()), 1000) == ids
    for cut in (0, 1, 400, 3999, 4000):
        a, b = ids[:cut], ids[cut:]
        assert token_files.crc_before(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(ids) or cut == 0


def check_packing(rows, texts_by_id, capacity=packing.SEQUENCE):
    whole = Tokenizer.from_file(BYTE)
    pieces, sequences = Counter(), defaultdict(list)
    for r in rows:
        pieces[(str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    want = Counter()
    for i, t in texts_by_id:
        ids = [*_ids(whole, t), 0]
        for a in range(0, len(ids), capacity):
            part = ids[a : a + capacity]
            want[(str(i), a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))] += 1
    assert pieces == want
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packing(docs, cases, empty):
    check_packing(packing.pack(docs, BYTE, 0, True).collect(), [(i, t) for i, t, _ in cases])
    assert packing.pack(empty, BYTE, 0, True).count() == 0


def test_histogram_packing_is_tight():
    rnd = random.Random(3)
    counts = Counter(rnd.randint(1, 1024) for _ in range(20000))
    patterns = packing.pack_histogram(counts)
    used = Counter()
    for group, n in patterns:
        assert sum(length * times for length, times in group) <= 1024
        for length, times in group:
            used[length] += times * n
    assert used == counts and len(patterns) < 3 * 1024
    assert sum(k * n for k, n in counts.items()) / (1024 * sum(n for _, n in patterns)) > 0.99


@pytest.mark.parametrize("counts", [{100: 1000}, {300: 1000}, {512: 7}, {1: 5000}, {700: 10, 300: 400, 5: 30}, {300: 10, 200: 300, 100: 3}])
def test_few_short_lengths_fill_their_packs(counts):
    patterns = packing.pack_histogram(counts)
    used = Counter()
    for group, n in patterns:
        assert sum(length * times for length, times in group) <= 1024
        for length, times in group:
            used[length] += times * n
    assert used == counts
    # no better than whole pieces allow: the best fill of one pack bounds them all
    reach = {0}
    for length in counts:
        reach = {r + length * t for r in reach for t in range((1024 - r) // length + 1)}
    least = -(-sum(k * n for k, n in counts.items()) // max(reach))
    assert sum(n for _, n in patterns) <= (least if len(counts) == 1 else 1.25 * least + 1)


def mixing_brute(cases):
    """Slot by slot over all blocks of all sources."""
    sizes = Counter()
    for _, t, s in cases:
        sizes[s or ""] += max(1, len(t or ""))
    total = sum(v**mixing.SMOOTHING for v in sizes.values())
    slots = {s: max(1, round(v**mixing.SMOOTHING / total * mixing.RESOLUTION)) for s, v in sizes.items()}
    period = sum(slots.values())
    done, order = Counter(), {}
    t = 0
    while any(done[s] * mixing.BLOCK < sizes[s] for s in sizes) and t < 5 * period:
        waiting = [(-(-(done[s] + 1) * period // n), s) for s, n in slots.items() if done[s] * period // n <= t]
        if waiting:
            s = min(waiting)[1]
            order[(s, done[s])] = t
            done[s] += 1
        t += 1
    return sizes, slots, period, order


def test_mixing_follows_earliest_deadline_first(spark, docs, cases, empty, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 700)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(cases)
    sizes, slots, period, order = mixing_brute(cases)
    horizon = min(order[(s, -(-sizes[s] // mixing.BLOCK))] for s in sizes if (s, -(-sizes[s] // mixing.BLOCK)) in order)
    for r in rows:
        assert r.slot == order[(r.source or "", r.block)] and r.block == r.place // mixing.BLOCK
        assert r.release <= r.slot < r.due and r.in_mix == (r.slot < horizon)
    assert mixing.mix(empty).count() == 0
    kept = mixing.mixture(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.in_mix for r in rows)
    places = defaultdict(int)
    for r in sorted(rows, key=lambda r: r.place):
        assert places[r.source or ""] == r.place
        places[r.source or ""] += r.chars


def test_a_tiny_source_ends_nothing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)
    rows = [(i, "x" * 50, f"s{min(2, i % 6)}") for i in range(12000)] + [(90000, "one row", None), *[(90001 + i, "x" * 50, "few") for i in range(5)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mixing.mixture(docs).count() < len(rows) // 2  # the first source runs out early
    got = [tuple(r) for r in dict(corpus_pipeline.STAGES)["mixing"](spark, docs, "").collect()]
    assert sorted(got) == sorted(rows)
    # each source is near its exact share as long as the three large ones last
    sizes = Counter()
    for _, t, s in rows:
        sizes[s or ""] += len(t)
    weights = {s: v**mixing.SMOOTHING for s, v in sizes.items()}
    ends = min(sizes[s] / weights[s] for s in ("s0", "s1", "s2"))
    served, total = Counter(), 0
    for _, t, s in got:
        served[s or ""] += len(t)
        total += len(t)
        if served["s0"] / weights["s0"] < 0.95 * ends and total > 5000:
            pace = [served[s] / weights[s] for s in ("s0", "s1", "s2")]
            assert max(pace) - min(pace) < 4 * mixing.BLOCK / min(weights[s] for s in ("s0", "s1", "s2"))
    few = [i for i, r in enumerate(got) if r[2] == "few"]
    assert few[-1] > len(got) // 10  # a source below one slot is not pulled to the front


def test_every_source_stays_within_one_block_of_its_share(spark):
    rows = [(i, "x" * 50, f"s{min(6, i % 13)}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.period_schedule(mixing.sources(docs, {"s0": 5, "s1": 3.3, "s2": 1, "s6": 0.01})).collect()
    by_slot = {r.slot: r for r in plan}
    period, served = plan[0].period, Counter()
    share = {r.source: r.slots / period for r in plan}
    assert sorted(by_slot) == list(range(period))
    for t in range(period):
        served[by_slot[t].source] += 1
        assert all(abs(served[s] - w * (t + 1)) < 1 for s, w in share.items())


def test_pipeline_against_brute_force(spark, docs, cases, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 700)
    compressor = zstandard.ZstdCompressor(level=quality.LEVEL)
    left = []
    for c in cases:
        n, _, _, _, again = quality.base_figures(c[1])
        if n >= 20 and 100 * again <= 30 * n and quality.compression(c[1], compressor)[3]:
            left.append(c)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]
    rows = stages["quality_rules"](spark, docs, "")
    assert rows.columns == docs.columns and Counter(str(r.doc_id) for r in rows.collect()) == Counter(str(c[0]) for c in left)
    keep = Counter(x[0] for x in exact_brute(left) if x[3])
    rows = stages["exact_dedup"](spark, rows, "")
    got = [(r.doc_id, r.text, r.source) for r in rows.collect()]
    assert Counter(str(r[0]) for r in got) == keep
    from barlake.llm.common import written

    rows = written(rows, "test-exact")
    near = near_brute(got)
    rows = written(stages["near_dedup"](spark, rows, ""), "test-near")
    got = [(r.doc_id, r.text, r.source) for r in rows.collect()]
    assert len(got) == round(sum(1 / x[2] for x in near))
    sizes, _, _, order = mixing_brute(got)
    rows = written(stages["mixing"](spark, rows, ""), "test-mix")
    ends = [order[(s, -(-sizes[s] // 700))] for s in sizes if (s, -(-sizes[s] // 700)) in order]
    assert 0 < rows.count() <= len(got) and ends
    check_packing(stages["packing"](spark, rows, "").collect(), [(r.doc_id, r.text) for r in rows.collect()])


def test_exact_stage_blocks(docs):
    assert exact_dedup.identities(docs, 32).count() == docs.count()


def test_scans_before_encoding_find_what_they_should():
    for c in "\t\r\x0b\x0c\x1c\x1f\x85\xa0 ᠎ ‍    ⁠　﻿":
        assert tokens._odd(f"a{c}b") and tokens._odd(f"ä{c}b一")
    assert tokens._odd("a <|b") and not tokens._odd("a b\nc < | ä一")
    assert all(map(tokens._gaps, (" a", "a ", "\na", "a\n", "a  b", "a\n\nb", "a \nb", "a\n b"))) and not tokens._gaps("a b\nc")


def test_a_word_of_letters_is_kept_once():
    own = tokens.Encoder(BYTE, True)
    own.ids("x word word. word, wörter wörter!")
    assert set(own.inner) == {"word", "word.", "word,", "wörter", "wörter!"} and set(own.marks) == {".", ",", "!"}
