"""Page extraction, importance resampling and phrases against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import collocations, html_extraction, resampling, spans
from barlake.llm.page_tree import judged_blocks, parse

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# importance resampling


@pytest.mark.parametrize("depth", [spans.DEPTH])
def test_span_checksums(depth):
    rnd = random.Random(1)
    data = rnd.randbytes(60_000)
    sizes = [1, 2, 3, depth - 1, depth, depth + 1, 2 * depth - 1, 2 * depth, 2 * depth + 1, 5 * depth, 20_000]
    where = [(a, a + n) for n in sizes for a in rnd.sample(range(30_000), 20)]
    starts, ends = np.array(where).T
    got = spans.span_crcs(np.frombuffer(data, np.uint8), starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in where]
    assert spans.span_crcs(np.frombuffer(data, np.uint8), starts[:0], ends[:0]).tolist() == []


def _features(text: str | None) -> tuple[int, list[int]]:
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def resample_brute(cases: list[tuple], target: list[str | None]) -> list[tuple]:
    s, t = Counter(), Counter()
    for _, text, _ in cases:
        s.update(_features(text)[1])
    for text in target:
        t.update(_features(text)[1])
    in_s, in_t = sum(s.values()) + 10_000.0, sum(t.values()) + 10_000.0
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * in_s / ((s[b] + 1.0) * in_t))) for b in range(10_000)]
    rows = []
    for i, text, _ in cases:
        n_words, found = _features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([i, len(found), weight, score, None, n_words >= 20])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, r in enumerate(able[: 25 * len(able) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in rows]


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_resampling(spark, docs, cases, empty):
    target = [cases[3][1], "the words of a target, 3 times; straße", None, ""]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(docs, table)
    assert _sorted(got.collect()) == _sorted(resample_brute(cases, target))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 5
    again = resampling.resample(docs.repartition(7), table.repartition(2))
    assert _sorted(again.collect()) == _sorted(got.collect())
    assert resampling.resample(empty, table).count() == 0
    nothing = resampling.resample(docs, table.limit(0)).collect()
    assert _sorted(nothing) == _sorted(resample_brute(cases, []))


def test_resampling_prefers_the_target(spark):
    rnd = random.Random(3)
    text = lambda k: " ".join(f"{'ab'[k]}{rnd.randrange(50)}" for _ in range(60))
    docs = spark.createDataFrame([(i, text(i % 2)) for i in range(400)], "doc_id long, text string")
    drawn = [r.doc_id % 2 for r in resampling.resample(docs, docs.where("doc_id % 2 = 1")).where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(drawn) > 60


# phrases


def phrases_brute(rows: list[tuple[str | None, str | None]], least: int, top: int) -> list[tuple]:
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        able = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in able.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longest[q] = max(longest[q], a)
        found = []
        for p, a in able.items():
            if len(p) == 2 and 100 * longest[p] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def _phrase_rows() -> list[tuple[str | None, str | None]]:
    rnd = random.Random(11)
    words = ["A", "b", "Ça", "d1", "e-e", "f", "g"]
    prose = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b"]) for _ in range(n))
    rows = [(rnd.choice(["en", "fr", None]), prose(rnd.randint(0, 120))) for _ in range(60)]
    rows += [("en", "new york city hall " * 30), ("en", "x " * 3000), ("fr", None), ("fr", ""), (None, " \t\n"), ("de", "one two"), ("en", "İ É " * 12)]
    return rows + rows[:10] * 3


@pytest.mark.parametrize("least,top", [(10, 2000), (3, 5)])
def test_collocations(spark, least, top):
    rows = _phrase_rows()
    docs = spark.createDataFrame([(t, lang, "x", 1) for lang, t in rows], "text string, lang string, phrase string, n long").repartition(3)
    got = collocations.collocations(docs, least, top)
    assert _sorted(got.collect()) == _sorted(phrases_brute(rows, least, top))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {f.name: f.dataType.simpleString() for f in got.schema}["score"] == "bigint"


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("rare words",)], "text string").withColumn("lang", F.lit("en"))).count() == 0


def _chunks(text: str) -> list[tuple[bytes, bool]]:
    data, starts, ends, _, ends_piece = collocations.chunks([text])
    return [(data[a:b].tobytes(), bool(e)) for a, b, e in zip(starts, ends, ends_piece)]


def test_chunks_overlap_and_every_run_is_assigned_once():
    rnd = random.Random(2)
    text = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(6000))
    parts = _chunks(text)
    assert len(parts) > 200 and [end for _, end in parts] == [False] * (len(parts) - 1) + [True]
    counts = Counter()
    for part, end in parts:
        words = part.decode().split()
        stop = len(words) if end else len(words) - 2
        for k in (1, 2, 3):
            counts.update(" ".join(words[i : i + k]) for i in range(min(stop, len(words) - k + 1)))
    words = text.split()
    assert counts == Counter(" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    # the same passage is cut alike in other surroundings
    assert len({p for p, _ in parts} - {p for p, _ in _chunks("q r s " + text + " t u")}) <= 2
    assert collocations.chunks(["", " .\t;"])[1].tolist() == []


def test_large_counts_stay_exact(spark):
    # products beyond 64 bits
    a, left = 3_000_000_000_000, 4_000_000_000_001
    frame = spark.createDataFrame([(a, left, left)], "a long, l long, r long")
    assert frame.select(collocations.score().alias("x")).first().x == 1_000_000 * a * a // (left * left)


# pages


def _text(source: str) -> str:
    return "\n".join(t for t, noise, _ in judged_blocks(parse(source, "h")) if not noise)


@pytest.mark.parametrize(
    "source,want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<br>two <b>bold<p>three</b> x", "one two bold\nthree x"),
        ("<title>t</title><style>p{}</style><script>a('</p>')</script><p>x&nbsp; y\n z", "x y z"),
        ("<body><nav><a href=/a>menu</a></nav><header>top</header><article><header><h1>H</h1></header><p>a</article><footer>f", "H\na"),
        ("<h1>Head</h1><div>before</div><article>in</article><div>after</div>", "Head\nin"),
        ("<main>m<aside>side</aside><section class='reader-comments'><p>c</p></section></main>", "m"),
        ("<form action=/><main>whole</main><input><select><option>o</select></form>", "whole"),
        ("<div class=sidebar><article>other</article></div><article>own</article>", "own"),
        ("<div class=cookieNotice>c</div><div id=ad-12>a</div><div class='post-header'>h</div><div hidden>x</div>", "h"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\n1\n2\n3"),
        ("1 < 2 <3 <p x='>'>q</p> <!-- a > b --> z <a href='unfinished", "1 < 2 <3\nq\nz"),
        ("<p>&#233;&eacute;&lt;p&gt;&#x1F600;", "éé<p>😀"),
        ("</p></div><p>a</b></i>b", "ab"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_blocks_of_a_page(source, want):
    assert _text(source) == want


def _site(n: int, host: str, names: bool) -> list[tuple[int, str, str]]:
    """Pages with a menu, a changing slogan and a footer that (without names) only repetition gives away."""
    rnd = random.Random(n)
    prose = lambda k: " ".join(rnd.choice(["ta", "ko", "mi", "ru"]) + str(rnd.randrange(90)) for _ in range(k))
    menu, foot = ("nav", "footer") if names else ("div", "div")
    out = []
    for i in range(n):
        body = "".join(f"<p>{prose(12)}</p>" for _ in range(rnd.randint(1, 5)))
        page = (
            f"<html><body><{menu} class=x1><a href=/>Home</a> <a href=/a>About</a></{menu}><div class=x2>Slogan {i % 3}</div>"
            f"<div class=x3>{body}</div><{foot} class=x4><p>Imprint of {host}</p></{foot}></body></html>"
        )
        out.append((i, f"https://{host}/{i}", page))
    return out


def test_repeated_branches_go_and_content_stays(spark):
    rows = _site(60, "large.example.org", False) + _site(2, "small.example.org", True)
    pages = spark.createDataFrame([(*r, "h", "k") for r in rows], "page_id long, url string, html string, host string, text string")
    got = {(r.page_id, r.url): r for r in html_extraction.extract(pages.repartition(3)).collect()}
    for i, url, source in rows:
        want = re.findall("<p>(.*?)</p>", source)[:-1]
        found = got[i, url]
        if "large" in url:
            assert found.text.split("\n") == want and found.n_low >= 3
        else:
            assert [x for x in found.text.split("\n") if not x.startswith("Slogan")] == want and found.n_ruled_out == 2
        assert found.n_chars == len(found.text)


def importance_brute(pages: list[tuple[str | None, str | None]]) -> dict[int, float]:
    from barlake.llm.page_tree import branches, features

    seen, counts, above = Counter(), defaultdict(list), {}
    for url, source in pages:
        page = parse(source, html_extraction.host_of(url))
        for node, up in branches(page):
            seen[node] += 1
            above[node] = up
        for node, kind, feature, n in features(page):
            counts[node, kind, feature].append(n)
    own = {}
    for node, m in seen.items():
        if m < 2:
            own[node] = 1.0
            continue
        styles = [sum(v) for (x, kind, _), v in counts.items() if x == node and kind == 0]
        entropy = lambda v: -sum(c / sum(v) * math.log(c / sum(v), m) for c in v)
        contents = [entropy(v) for (x, kind, _), v in counts.items() if x == node and kind == 1]
        best = max(entropy(styles), 1 - sum(contents) / len(contents) if contents else 0.0, 0.0)
        own[node] = (html_extraction.EVIDENCE + m * min(1.0, best)) / (html_extraction.EVIDENCE + m)
    out = dict(own)
    for node, value in own.items():
        for up in above[node]:
            out[up] = max(out[up], value)
    return out


def test_importance(spark):
    rows = _site(12, "a.example.org", False) + _site(3, "b.example.org", True) + [(9, None, "<p>x"), (9, None, "<p>x"), (8, "http://[", None), (7, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.node: r.importance for r in html_extraction.importance(html_extraction.parsed(pages)).collect()}
    want = importance_brute([(url, source) for _, url, source in rows])
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    rest = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_extraction.extract(pages).where("page_id in (7, 8, 9) and url is null or url in ('', 'http://[')").collect()}
    assert rest[9, None] == ("x", 1) and rest[8, "http://["] == ("", 0) == rest[7, ""]
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_runs_are_counted_by_one_key(spark):
    rows = [("a\nb", "x y. x y", True), ("a", "b\tx y", True), ("", "x y", True), ("日本", "日 本", True)]
    docs = spark.createDataFrame([(t, lang) for lang, t, _ in rows], "text string, lang string")
    counts = collocations.run_counts(collocations.parse(docs), (1, 2))
    assert counts.dtypes == [("lang", "string"), ("n_words", "int"), ("phrase", "binary"), ("f", "bigint")]
    got = {(r.lang, r.n_words, bytes(r.phrase).decode()): r.f for r in counts.collect()}
    assert got == {
        ("a\nb", 1, "x"): 2, ("a\nb", 1, "y"): 2, ("a\nb", 2, "x y"): 2,
        ("a", 1, "b"): 1, ("a", 1, "x"): 1, ("a", 1, "y"): 1, ("a", 2, "b x"): 1, ("a", 2, "x y"): 1,
        ("", 1, "x"): 1, ("", 1, "y"): 1, ("", 2, "x y"): 1,
        ("日本", 1, "日"): 1, ("日本", 1, "本"): 1, ("日本", 2, "日 本"): 1,
    }
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "keys=[key#" in plan and "keys=[lang#" not in plan.split("MapInArrow")[0]
