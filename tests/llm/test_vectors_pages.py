"""Operators 4 (cap filters), 5 (licences), 6 (WARC) and 9 (toxicity)."""
import base64
import hashlib
import math
import random

import numpy as np
import pytest

from peerscope.llm import capfilters, licenses, toxicity, warc
from tests.llm import brute


def links_of(rows, t=0.95):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [(k, unit(v)) for k, v in rows]
    found, count = [], [0] * len(rows)
    for i, (a, x) in enumerate(units):
        for j, (b, y) in enumerate(units):
            if i != j and x is not None and y is not None and len(x) == len(y) and x @ y >= t:
                found.append((a, b))
                count[i] += 1
    comp = brute.roots([k for k, _ in rows], found)
    return sorted((k, n, comp[k], k == comp[k]) for (k, _), n in zip(rows, count, strict=True))


@pytest.mark.parametrize("cap_rows", [2048, 4])
def test_cap_filters(spark, monkeypatch, cap_rows):
    monkeypatch.setattr(capfilters, "CAP_ROWS", cap_rows)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(30):
        v = rng.normal(size=32)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows) + 10, (v + rng.normal(size=32) * rng.choice([0, 0.05, 0.2])).tolist()))
    rows += [(1, None), (2, []), (3, [0.0] * 32), (4, [math.nan] * 32), (5, [1.0] * 31 + [None]), (6, [math.inf] * 32),
             (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [5e-324, 0.0]), (300, [1e300] * 32), (301, [1e300] * 32), (10, rows[0][1])]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, component_id int")
    got = capfilters.near_duplicates(df)
    assert sorted(tuple(r) for r in got.collect()) == links_of(rows)
    assert capfilters.near_duplicates(df.where("vec_id < 0")).count() == 0
    alone = capfilters.near_duplicates(df.where("vec_id < 7"))
    assert sorted(tuple(r) for r in alone.collect()) == [(k, 0, k, True) for k in range(1, 7)]


def test_cap_recall_and_decoding():
    code = capfilters.ProductCode(24, 5, 12)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, cap = code.decode(x)
    whole = code._combined([(x @ code.rotation)[:, a:b] @ c.T for a, b, c in zip(code.cuts, code.cuts[1:], code.code)])
    assert set(zip(row.tolist(), cap.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(whole > code.threshold))))
    # pairs right at the threshold share a cap in nine of ten cases at least
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    n = rng.normal(size=a.shape)
    n -= (n * a).sum(axis=1, keepdims=True) * a
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * n
    met = np.zeros(len(a), bool)
    for number in range(capfilters.CODES):
        code = capfilters.ProductCode(64, 225, number=number)
        caps = [[set(c[r == i].tolist()) for i in range(len(a))] for r, c in (code.decode(a), code.decode(b))]
        met |= np.array([bool(p & q) for p, q in zip(*caps)])
    assert met.mean() > 0.98


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 3)
    tricky = "é" * 9000 + "WARC/1.1\r\n\r\n0\r\n\r\n" + "<p>\r\n" * 40
    pages = [(5, "http://a/", tricky), (3, "http://b/", "same"), (9, "http://c/\r\nX: y", "same"), (7, None, None), (8, "u", ""),
             (1, "u", tricky), (20, "u", "WARC/1.1\r\n"), (21, "u", "x" * 40000), (3, "http://b/", "same"),
             (30, "http://w/WARC/1.1", "WARC/1.1\r\n" * 700 + "é")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, record_type string")
    for segment in (16 << 10, 50):
        monkeypatch.setattr(warc, "SEGMENT_BYTES", segment)
        monkeypatch.setattr(warc.write_archives, "__defaults__", (0, segment))
        got = sorted(tuple(r) for r in warc.archive_summary(df).collect())
        want = []
        for k, _, html in pages:
            raw = (html or "").encode()
            first = min(p[0] for p in pages if (p[2] or "") == (html or ""))
            digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
            want.append((k, len(raw), digest, "response" if first == k else "revisit", None if first == k else first))
        assert got == sorted(want, key=lambda r: (r[0], r[1]))
    assert warc.archive_summary(df.where("page_id < 0")).count() == 0


def test_warc_payloads_and_small_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long text"), (4, "u", "long text")], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), least_bytes=5, segment_bytes=40)
    read = {r["page_id"]: r for r in warc.read_pages(warc.read_records(spark, str(tmp_path / "w"))).collect()}
    assert [read[k]["record_type"] for k in (1, 2, 3, 4)] == ["response", "response", "response", "revisit"]
    assert bytes(read[3]["payload"]) == b"long text" and read[4]["refers_to"] == 3 and read[4]["payload"] is None


def test_warc_reads_long_pages_in_linear_time(spark, tmp_path):
    """A page full of version lines, in one record and in segments: seconds, where rereading would take hours."""
    text = "WARC/1.1\r\n" * 600_000
    pages = spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")
    for n, segment in enumerate((64 << 20, 16 << 10)):
        warc.write_archives(pages, str(tmp_path / f"w{n}"), segment_bytes=segment)
        row = warc.read_pages(warc.read_records(spark, str(tmp_path / f"w{n}"))).first()
        assert bytes(row["payload"]) == text.encode()


def test_warc_missing_segment_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc" * 100)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), segment_bytes=100)
    records = warc.read_records(spark, str(tmp_path / "w"))
    with pytest.raises(Exception, match="don't fit"):
        warc.read_pages(records.where("segment IS NULL OR segment <> 2")).collect()


def test_chunked_round_trip():
    for body in (b"", b"a", b"0\r\n\r\n" * 3000):
        assert warc.unchunked(warc.chunked(body, 7)) == body
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_licenses(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("a/LICENSE.txt", f"text\n{mit}"), ("a/b/y.txt", "plain"), ("a/b/c/COPYING", f"{gpl}\nmore the the"), ("a/b/c/w.txt", None),
            ("q/u.txt", ""), ("top.txt", "nothing licensed here"), (None, mit), (None, "x"), ("a/b/c/w.txt", None)]
    rows += [(f"n/{i}.txt", "the work of this version is under the sea " * 3) for i in range(40)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "path string, text string, license string")
    got = [tuple(r) for r in licenses.inherited(licenses.own_licenses(df)).select("path", "license", "license_path").collect()]
    by = {k: v for k, *v in got if k}
    assert by["a/LICENSE.txt"] == ["MIT", "a/LICENSE.txt"] and by["a/b/y.txt"] == ["MIT", "a/LICENSE.txt"]
    assert by["a/b/c/COPYING"] == ["GPL-3.0", "a/b/c/COPYING"] and by["a/b/c/w.txt"] == ["GPL-3.0", "a/b/c/COPYING"]
    assert by["q/u.txt"] == [None, None] and by["top.txt"] == [None, None] and by["n/3.txt"] == [None, None]
    assert sorted(str(x[1]) for x in got if x[0] is None) == ["MIT", "None"] and len(got) == len(rows)
    assert licenses.inherited(licenses.own_licenses(df.where("path = '-'"))).count() == 0


def test_license_lines_are_judged_like_by_brute_force(spark):
    rng = random.Random(2)
    vocab = [w for _, t in licenses.TEMPLATES for w in t.split()] + ["foo", "bar"]
    rows = []
    for i in range(200):
        name, t = rng.choice(licenses.TEMPLATES)
        w = [rng.choice(vocab) if rng.random() < 0.25 else x for x in t.split()]
        rows.append((f"{i}", "lead in\n" + " ".join(w) + "\ntail"))
    df = spark.createDataFrame(rows, "path string, text string")
    freq, n = licenses.template_frequencies(df, "text")
    assert n == 200
    m, terms = licenses.Matcher(licenses.TEMPLATES, freq, n, licenses.THRESHOLD), licenses.Terms()
    for r in licenses.own_licenses(df).collect():
        best = max(m.best(terms.of_text(line.encode()))[0] for line in r["text"].split("\n"))
        assert (r["own"] is not None) == (best >= licenses.THRESHOLD)
        if r["own"] is not None:
            assert abs(r["own"]["similarity"] - best) < 1e-9


def toxic_corpus(n=900):
    rng = random.Random(4)
    plain = "the quick brown market garden river window table people story morning evening simple little number paper".split()
    bad = ["idiot", "stupid", "moron"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * 2):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    disguised = ["you 1d10t there", "such a s t u p i d thing", "STUUUUUPID!!!", "m0r0n", "a$$$ the quick brown", "room 101 at 10:30", None, "", "x" * 5000]
    rows += [(5000 + i, t) for i, t in enumerate(disguised)] + [(5001, disguised[1])]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored_documents(docs.select("doc_id", "text"), lab).collect()}
    truth = dict((i, y) for i, _, y in labels)
    held = [r["doc_id"] for r in docs.where(toxicity.held_out()).select("doc_id").collect() if r["doc_id"] in truth]
    assert len(held) > 100 and np.mean([(got[i] >= 0.5) == truth[i] for i in held]) > 0.98
    assert [got[5000 + i] >= 0.5 for i in range(len(disguised))] == [True] * 4 + [False] * 5
    named = toxicity.scored_documents(docs, lab, out="_t")
    assert named.columns == ["doc_id", "text", "score", "_t"]
    assert toxicity.scored_documents(docs.where("doc_id < 0"), lab).count() == 0
    assert {r["score"] for r in toxicity.scored_documents(docs, lab.where("doc_id < 0")).collect()} == {0.0}


def test_viterbi_restores_text(spark):
    rows, _ = toxic_corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    r = toxicity.channel(docs).value
    assert r.text("You 1D10T, such a s.t.u.p.i.d m0r0n!!") == "you idiot such a stupid moron"
    assert r.text(None) == "" and r.word("windooooow") == "window" and r.word("555-1234") == ""


def test_spaced_signs_and_doubled_letters_are_restored(spark):
    rows, _ = toxic_corpus(300)
    r = toxicity.channel(spark.createDataFrame(rows, "doc_id long, text string")).value
    forms = {"idiot": ["1 d 1 0 t", "i  d  i  o  t", "i\nd\ni\no\nt", "iddiioott", "1 D 1 O T"],
             "stupid": ["5 t u p 1 d", "stuupid", "s \t t u p i d", "sttuuppiidd"], "moron": ["m 0 r 0 n", "moorroon"]}
    for want, texts in forms.items():
        for text in texts:
            assert r.text(f"the quick {text} river") == f"the quick {want} river", text
    assert r.text("little 1 2 3 4 paper") == "little paper" and r.tokens("1 2 3 4") == ["1", "2", "3", "4"]
