"""Exact, near and passage deduplication against brute-force versions."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barlake.llm import exact_dedup, near_dedup, repeats, suffixes

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _last(doc):
    return (doc is not None, doc or 0)


def exact_brute(cases):
    groups = defaultdict(list)
    for i, t, _ in cases:
        groups[(t or "").translate(UPPER)].append(i)
    out = []
    for norm, ids in groups.items():
        top = max(ids, key=_last)
        first = True
        for i in ids:
            out.append((str(i), str(top), len(ids), i == top and first, hashlib.sha256(norm.encode()).hexdigest()))
            first = first and i != top
    return sorted(out)


@pytest.mark.parametrize("block", [16, exact_dedup.BLOCK])
def test_exact_dedup(docs, cases, block):
    rows = exact_dedup.exact_dedup(docs, block).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in rows) == exact_brute(cases)


def test_exact_dedup_splits_hot_blocks(docs, cases, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_LEAST", 2)
    rows = exact_dedup.exact_dedup(docs, 64).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in rows) == exact_brute(cases)


def test_exact_dedup_keeps_one_row_each(docs, cases, empty):
    kept = exact_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns
    expected = Counter(x[0] for x in exact_brute(cases) if x[3])
    assert Counter(str(r.doc_id) for r in kept.collect()) == expected
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.keep_one_each(empty).count() == 0


def near_brute(cases):
    bags = [near_dedup.shingles(t) for _, t, _ in cases]
    root = list(range(len(cases)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(cases)):
        for b in range(a):
            same = (cases[a][1] or "") == (cases[b][1] or "")
            if same or near_dedup.similarity(bags[a], bags[b]) >= near_dedup.SIMILARITY:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for x in range(len(cases)):
        groups[find(x)].append(cases[x][0])
    return sorted((str(i), str(min(ids, key=_last)), len(ids)) for ids in groups.values() for i in ids)


def test_near_duplicates(docs, cases, empty):
    rows = near_dedup.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in rows) == near_brute(cases)
    assert sum(r.kept for r in rows) == round(sum(1 / x[2] for x in near_brute(cases)))
    kept = near_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_links_a_chain_in_shared_buckets(spark, tmp_path):
    """Copies changed step by step: neighbours are near, the ends are not; one class all the same."""
    rnd = np.random.default_rng(2)
    words = [f"w{x}" for x in rnd.integers(0, 5000, 300)]
    rows = []
    for k in range(40):
        rows.append((k, " ".join(words)))
        for at in rnd.integers(0, 300, 3):
            words[at] = f"n{k}x{at}"
    rows += [(100 + k, " ".join(f"w{x}" for x in rnd.integers(0, 5000, 100))) for k in range(30)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    out = near_dedup.near_duplicates(spark.read.parquet(path)).collect()
    cases = [(i, t, None) for i, t in rows]
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in out) == near_brute(cases)


def test_signatures_estimate_weighted_similarity():
    rnd = np.random.default_rng(4)
    errors = []
    for _ in range(40):
        a = rnd.integers(0, 9, 60)
        b = np.where(rnd.random(60) < 0.3, rnd.integers(0, 9, 60), a)
        names = rnd.integers(1, 2**62, 60).astype(np.uint64)
        bags = [(names[x > 0], x[x > 0]) for x in (a, b)]
        first = near_dedup.signatures(bags, 1024)
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        errors.append((first[0] == first[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def repeats_brute(cases, match=suffixes.MATCH):
    seen, out = set(), []
    for i, t, _ in sorted(cases, key=lambda c: (_last(c[0]), c[1] or "")):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, int)
        for s in range(len(raw) - match + 1):
            window = raw[s : s + match]
            if window in seen:
                gone[s : s + match] = 1
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        runs = int((np.diff(np.concatenate(([0], gone))) == 1).sum())
        out.append((str(i), len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group,batches", [(repeats.GROUP, (0.125, 1.0)), (2, (0.2, 0.4, 0.6, 0.8, 1.0))])
def test_repeats(docs, cases, monkeypatch, group, batches):
    """Also with groups so small that all go the long way, and with several levels of the index."""
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = repeats.remove_repeats(docs, batches).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == repeats_brute(cases)


def test_repeats_with_unique_ids(spark, cases, empty, tmp_path):
    some = [(k, t, s) for k, (_, t, s) in enumerate(cases)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t) for i, t, _ in some], "doc_id long, text string").repartition(4).write.parquet(path)
    rows = repeats.remove_repeats(spark.read.parquet(path), with_text=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == repeats_brute(some)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    assert repeats.remove_repeats(empty).count() == 0


def _changed_versions(n: int, seed: int = 4) -> list[str]:
    rnd = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(140)]
    out = []
    for k in range(n):
        words = base[: int(rnd.integers(110, 141))] if k % 4 == 0 else list(base)
        for place in rnd.choice(len(words), int(rnd.integers(0, 12)), replace=False):
            words[place] = f"v{rnd.integers(0, 40)}"
        out.append(" ".join(words))
    return out


def test_measures_by_a_leader_never_rule_out_a_link(spark):
    bags = [near_dedup.shingles(t) for t in _changed_versions(40)] + [near_dedup.shingles("a b c d e " * k) for k in (3, 9, 12)]
    rows = [(i, *near_dedup.beyond(b, bags[j])) for j in (0, 5, 41) for i, b in enumerate(bags)]
    frame = spark.createDataFrame([(k // len(bags), *r) for k, r in enumerate(rows)], ["by", "i", *near_dedup.MEASURES])
    pairs = frame.join(frame.toDF("by", *[f"{c}2" for c in frame.columns[1:]]), "by").where("i < i2").where(~near_dedup._room())
    out = {(r.i, r.i2) for r in pairs.select("i", "i2").collect()}
    like = {(a, b) for a in range(len(bags)) for b in range(a + 1, len(bags)) if near_dedup.similarity(bags[a], bags[b]) >= near_dedup.SIMILARITY}
    assert like and not out & like and len(out) > 300


def test_changed_versions_of_one_text_are_not_compared_in_pairs(spark, monkeypatch):
    texts = _changed_versions(150)
    cases = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in cases], "doc_id long, text string").repartition(3)
    compared, verify = [], near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", lambda pairs, texts: compared.append(pairs.count()) or verify(pairs, texts))
    got = sorted((r.doc_id, r.class_id) for r in near_dedup.near_duplicates(docs).collect())
    bags = [near_dedup.shingles(t) for t in texts]
    comp = list(range(len(bags)))
    for a in range(len(bags)):
        for b in range(a):
            if comp[a] != comp[b] and near_dedup.similarity(bags[a], bags[b]) >= near_dedup.SIMILARITY:
                comp = [min(comp[a], comp[b]) if c in (comp[a], comp[b]) else c for c in comp]
    assert got == list(enumerate(comp))
    assert sum(compared) < 4 * len(texts)
