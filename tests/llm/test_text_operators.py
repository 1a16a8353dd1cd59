"""Quality, personal data and toxicity against brute-force versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from barlake.llm import pii, quality, toxicity


def _base(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_figures_and_verdict(docs, cases, empty):
    rows = quality.quality(docs).collect()
    expected = []
    for doc, text, _ in cases:
        base = _base(text)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        raw = (text or "").encode()
        ratio = len(zstandard.ZstdCompressor(level=quality.LEVEL).compress(raw)) / len(raw) if raw else 1.0
        expected.append((str(doc), *base, failed, round(ratio, 9)))
    got = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, round(r.zstd_ratio, 9)) for r in rows]
    assert sorted(got) == sorted(expected)
    assert all(not r.kept for r in rows if r.base_failed)
    clean = {r.doc_id for r in rows if r.kept}
    assert set(range(30)) <= clean and 87 not in clean and 88 not in clean
    assert quality.quality(empty).count() == 0
    assert quality.good_documents(docs).columns == docs.columns


def test_compression_bands_reject_repetition_and_noise():
    compressor = zstandard.ZstdCompressor(level=quality.LEVEL)
    rnd = np.random.default_rng(3)
    noise = "".join(chr(33 + x) for x in rnd.integers(0, 94, 6000))
    prose = " ".join("".join(chr(97 + c) for c in rnd.integers(0, 20, n)) for n in rnd.integers(2, 6, 200)).encode()
    assert not quality.compression(noise, compressor)[3]
    assert not quality.compression("all the same words " * 300, compressor)[3]
    assert quality.compression(prose.decode()[:200], compressor)[3]
    # one bad chunk among many good ones does not fail a text, many do
    assert quality.compression("", compressor) == (1.0, 0, 0, True)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _holds(kind: str, m: str) -> bool:
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def _spans(text: str) -> list[tuple[int, int, str, int]]:
    return sorted(
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if _holds(kind, m.group())
    )


HARD = [
    "a@b.c%d@e.f. x@y z@@w.q .@-.- a..b@c..d",
    "1.2.3.4.5.6.7.8 1.02.003.0255 999.1.1.1 1.2.3.00000000000255",
    "4111-1111 11111111 5 4 4111111111111111 12345678901234567890123",
    "+1 23 +1234567890 +1-(2).3 4567 890- + 1 +49 (0)30 123456789012345",
    "é😀 a@b.c 😀 4111 1111 1111 1111" * 300,
    "7" * 20000 + " " + "a" * 20000 + "@" + "b.c" * 5000,
]


def test_personal_data_against_plain_regular_expressions(spark, docs, cases, empty):
    rows = pii.digest(pii.find_pii(docs)).collect()
    hard = pii.digest(pii.find_pii(spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string"))).collect()
    expected = [(str(i), t) for i, t, _ in cases] + [(f"h{i}", t) for i, t in enumerate(HARD)]
    got = [(str(r.doc_id), r) for r in rows] + [(f"h{r.doc_id}", r) for r in hard]
    want = []
    for i, t in expected:
        spans = _spans(t)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()
        want.append((i, *[sum(s[2] == k for s in spans) for k in BASE], digest))
    assert sorted((i, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for i, r in got) == sorted(want)
    extra = next(r for r in rows if r.doc_id == 96)
    assert extra.n_iban == 1 and extra.n_ssn >= 1  # the second account number fails mod 97
    assert pii.find_pii(empty).count() == 0
    clean = {r.doc_id: r.text for r in pii.redact(docs.where("doc_id in (82, 95)")).collect()}
    assert clean[95].startswith("Mail [email] or [phone], card [card], ip [ip] and 1.2.3.256")


IBANS = [
    ("IBAN GB82WEST12345698765432 Please pay", "GB82WEST12345698765432"),
    ("IBAN GB82 WEST 1234 5698 7654 32 Please pay", "GB82 WEST 1234 5698 7654 32"),
    ("IBAN DE89370400440532013000 BIC COBADEFFXXX", "DE89370400440532013000"),
    ("DE89 3704 0044 0532 0130 00 12345 PAID", "DE89 3704 0044 0532 0130 00"),
    ("é😀 ref AB12 NO93 8601 1117 947 A", "NO93 8601 1117 947"),
    ("NO12 AB34 DE89 370 DE89 3704 0044 0532 0130 00.", "DE89 3704 0044 0532 0130 00"),
]


def test_account_numbers_before_capitals_and_numbers(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(IBANS)], "doc_id long, text string")
    found = {r.doc_id: [s for s in r.spans if s.kind == "iban"] for r in pii.find_pii(docs).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    for i, (text, number) in enumerate(IBANS):
        at = text.index(number)
        assert [(s.start, s.end, s.value) for s in found[i]] == [(at, at + len(number), number)]
        assert clean[i] == text.replace(number, "[iban]")
    two = "DE89370400440532013000 GB82WEST12345698765432"
    pair = spark.createDataFrame([(1, two), (2, "AA11 " * 20000)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redact(pair).collect()} == {1: "[iban] [iban]", 2: "AA11 " * 20000}


def test_toxicity_learns_from_positives_and_unlabelled(spark, empty, tmp_path):
    rnd = np.random.default_rng(1)
    words = ["".join(chr(97 + c) for c in rnd.integers(0, 18, n)) for n in rnd.integers(3, 8, 300)]
    rows, labels = [], []
    for i in range(600):
        body = list(rnd.choice(words, 60))
        toxic = i % 6 == 0
        if toxic:
            for at in rnd.integers(0, 60, 3):
                body[at] = rnd.choice(["vilewort", "zuxnasty"])
        rows.append((i, " ".join(body)))
        if i % 5 < 3:
            labels.append((i, 1, int(toxic)))
    rows += [(None, None), (700, ""), (701, None)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, known).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [(r.doc_id % 6 == 0, r.predicted) for r in out if r.doc_id is not None and r.doc_id < 600 and r.held_out]
    assert np.mean([t == bool(p) for t, p in held]) > 0.9
    # nothing to learn from
    assert all(r.predicted == 0 for r in toxicity.toxicity(docs, known.limit(0)).collect())
    assert toxicity.toxicity(empty, known).count() == 0


def test_non_negative_risk_needs_no_clean_examples():
    rnd = np.random.default_rng(0)
    clean = [np.sort(rnd.choice(200, 40, False)) for _ in range(400)]
    toxic = [np.sort(np.append(rnd.choice(200, 40, False), 500 + rnd.choice(3))) for _ in range(200)]
    model = toxicity.fit(toxic[:100], [*clean[:200], *toxic[100:130]], 0.13)
    score = lambda found: 1 / (1 + np.exp(-(model.table[found].sum() + model.bias)))
    assert np.mean([score(x) > 0.5 for x in toxic[130:]]) > 0.95
    assert np.mean([score(x) > 0.5 for x in clean[200:]]) < 0.05


@pytest.mark.parametrize("text", ["", "a", "ab cd", "ÄÖ ß", "x" * 100])
def test_runs_of_odd_texts(text):
    found = toxicity.runs(text)
    assert (np.diff(found) > 0).all() and (len(found) == 0 or found[-1] < toxicity.DIMS)
