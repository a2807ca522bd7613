"""License scans against a search without an automaton."""

from __future__ import annotations

import random
import re

import pytest

from plumbline.llm import licenses, queries
from plumbline.llm.license_texts import PHRASES, TEMPLATES
from tests.llm.edges import frame, rows as edge_rows


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_places(text, phrases):
    seq = words(text)
    return sorted((i, label) for label, phrase in phrases for i in range(len(seq)) if words(phrase) and seq[i : i + len(words(phrase))] == words(phrase))


def brute_matches(text, template, least):
    """Maximal common runs of at least `least` words: (start in the text, end, start in the template)."""
    a, b, out = words(text), words(template), set()
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] == b[j] and not (i and j and a[i - 1] == b[j - 1]):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                if n >= least:
                    out.add((i, i + n, j))
    return out


def mentions():
    rng = random.Random(4)
    pool = ["the mit license", "MIT-License", "mit mit license", "Apache\nLicense", "GNU General Public License", "general public license general public license", "lorem ipsum", "permitted", "é mit", "license"]
    return [" ".join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(120)]


def test_phrases_by_brute_force(spark):
    texts = mentions()
    rows = [(i, t, None, None, None, None, None, None, None, None) for i, t in enumerate(texts)] + [(1000 + k, r[1], *r[2:]) for k, r in enumerate(edge_rows())]
    out = {r.row.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}
    assert len(out) == len(rows)
    for r in rows:
        assert out[r[0]].n_words == len(words(r[1]))
        assert [(p.start, p.label) for p in out[r[0]].places] == brute_places(r[1], PHRASES)
        assert 0 <= out[r[0]].score <= 1


def test_matches_by_brute_force():
    rng = random.Random(6)
    for least in (1, 2, 4):
        for _ in range(120):
            templates = [("x", " ".join(rng.choices("abc", k=rng.randint(1, 14)))) for _ in range(3)]
            text = " ".join(rng.choices("abcd", k=rng.randint(0, 40)))
            m = licenses.Matcher(templates, [("p", "a b")], least)
            got = {}
            m._found = lambda n, places, matches: got.update(matches)
            m.scanned([text.encode()])
            for t, (_, template) in enumerate(templates):
                assert sorted(got.get(t, [])) == sorted(brute_matches(text, template, least))


def test_statistics_by_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        templates = [("x", " ".join(rng.choices("abc", k=rng.randint(1, 12)))) for _ in range(3)]
        m = licenses.Matcher(templates, [])
        seq = [m.number.get(w.encode(), -1) for w in rng.choices("abcd", k=30)]
        held = [" " + " ".join(map(str, s)) + " " for _, s in m.templates]
        for at, (_, length) in enumerate(m.statistics(seq), 1):
            assert length == max(n for n in range(at + 1) if n == 0 or any(" " + " ".join(map(str, seq[at - n : at])) + " " in h for h in held))


@pytest.mark.parametrize("number", range(len(TEMPLATES)))
def test_each_template_is_its_own_label(number):
    label, text = TEMPLATES[number]
    m = licenses.Matcher(TEMPLATES, PHRASES)
    found = m.scanned([f"Some words before. {text} And some after it.".encode(), b"nothing of the kind here", None])
    assert {s["label"] for s in found[0]["spans"]} == {label}
    assert max(s["coverage"] for s in found[0]["spans"]) == 1
    assert found[1]["spans"] == found[2]["spans"] == [] and found[2]["n_words"] == 0


def test_changed_copies_keep_their_label():
    rng = random.Random(9)
    m = licenses.Matcher(TEMPLATES, PHRASES)
    for label, text in TEMPLATES:
        seq = words(text)
        if len(seq) < 60:
            continue
        for _ in range(5):
            changed = [w if rng.random() > 0.01 else "changed" for w in seq]
            at = rng.randint(10, len(seq) - 10)
            changed[at:at] = ["put", "in", "between"]
            assert label in {s["label"] for s in m.scanned([" ".join(changed).encode()])[0]["spans"]}


def test_many_copies_in_one_text():
    m = licenses.Matcher(TEMPLATES, PHRASES)
    text = TEMPLATES[0][1]
    found = m.scanned([(text * 300).encode()])[0]
    assert len(found["spans"]) == 300 and {s["coverage"] for s in found["spans"]} == {1.0}


def test_half_a_template_is_none():
    m = licenses.Matcher(TEMPLATES, ())
    half = words(TEMPLATES[0][1])[:80]
    assert m.scanned([" ".join(half).encode()])[0]["spans"] == []


def test_other_templates_empty_tables_and_columns(spark):
    assert licenses.scan(frame(spark, [])).collect() == []
    rows = spark.createDataFrame([(1, "own words here now", "a", "b")], "doc_id long, text string, found string, row string")
    out = licenses.scan(rows, templates=[("own", "own words here now"), ("none", "")], phrases=[("p", "words here"), ("q", "!")]).collect()
    assert [(s.label, s.start, s.end) for s in out[0].spans] == [("own", 0, 4)] and [p.label for p in out[0].places] == ["p"]
    assert out[0].row.found == "a"
    out = licenses.scan(rows, templates=[], phrases=[]).first()
    assert (out.n_words, out.places, out.spans, out.score) == (4, [], [], 0)
    with pytest.raises(ValueError):
        licenses.scan(rows, templates=[(None, "text")])


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    out = {r.doc_id: r for r in queries.op13_license_scan(spark, sf).collect()}
    assert len(out) == len(docs)
    for d in docs:
        places, r = brute_places(d.text, PHRASES), out[d.doc_id]
        assert (r.n_words, r.n_base) == (len(words(d.text)), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
