"""License notices against an exhaustive alignment."""

import random
import re

import pytest

from tagmill.llm import licenses, text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FILL = "lorem ipsum dolor sit amet the of software license copy any under version permission work is this".split()


def words(value):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in value or ""))


def phrase_places(value):
    got = words(value)
    return sorted((i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(got))
                  if got[i:i + len(phrase.split())] == phrase.split())


def subsequence(a, b):
    """Longest common subsequence by the table of all prefixes."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def notices(template, r, edits):
    """A template with some words replaced, left out or put in."""
    out = words(template)
    for _ in range(edits):
        at = r.randrange(1, len(out) - 1)
        out[at:at + 1] = r.choice(([], ["zzz"], [out[at], "zzz"]))
    return " ".join(out)


def scan(frame):
    return {r.doc_id: r for r in licenses.scan(frame).collect()}


def test_base_places_equal_brute_force(docs_of, monkeypatch):
    r = random.Random(2)
    parts = FILL + list(licenses.PHRASES) + ["MIT", "Apache-License", "general public", "GENERAL, Public; license!"]
    rows = [(i, " ".join(r.choice(parts) for _ in range(r.randint(0, 60)))) for i in range(150)] + [(900, None), (901, ""), (902, "İ MİT license")]
    for size in (1 << 22, 50):
        monkeypatch.setattr(text.pieces, "__defaults__", (size,))
        got = scan(docs_of(rows))
        for i, t in rows:
            places = phrase_places(t)
            assert (got[i].n_words, got[i].n_base) == (len(words(t)), len(places))
            assert (got[i].first_word, got[i].last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
            assert got[i].base_labels == ",".join(sorted({label for _, label in places}))
            assert set(got[i].base_labels.split(",")) - {""} <= set(got[i].labels.split(","))


def test_notices_are_found_with_edits_and_clean_texts_stay_clean(docs_of, monkeypatch):
    r, rows, want = random.Random(3), [], {}
    for label, template in licenses.TEMPLATES:
        for copies in (1, 2):
            n = len(words(template))
            edits = n // 16
            inside = " ".join(" ".join([*r.choices(FILL, k=40), notices(template, r, edits)]) for _ in range(copies))
            want[len(rows)] = label
            rows.append((len(rows), f"{' '.join(r.choices(FILL, k=30))}. {inside} {' '.join(r.choices(FILL, k=60))}"))
    clean = range(1000, 1100)
    rows += [(i, " ".join(r.choices(FILL, k=300))) for i in clean]
    for size in (1 << 22, 200):
        monkeypatch.setattr(text.pieces, "__defaults__", (size,))
        got = scan(docs_of(rows))
        missed = [i for i, label in want.items() if label not in got[i].labels.split(",")]
        assert not missed, [rows[i] for i in missed]
        assert not [i for i in clean if got[i].notices]


def test_spans_reach_the_asked_share(docs_of):
    """Every span holds the share of its template that it claims, and whole templates are found where they stand."""
    r = random.Random(5)
    rows, at = [], {}
    for i, (label, template) in enumerate(licenses.TEMPLATES):
        lead = r.choices(FILL, k=r.randint(0, 80))
        at[i] = (label, len(lead), len(lead) + len(words(template)) - 1)
        rows.append((i, " ".join([*lead, template, *r.choices(["tail", "end"], k=20)])))
    got = scan(docs_of(rows))
    for i, (label, first, last) in at.items():
        assert any(n.label == label and n.first <= first and n.last >= last and n.share >= licenses.LEAST_WORDS
                   for n in got[i].notices), (i, got[i], at[i])
        for n in got[i].notices:
            own = words(rows[i][1])[max(0, n.first - licenses.DRIFT):n.last + 1 + licenses.DRIFT]
            assert max(subsequence(own, words(t)) / max(len(words(t)), n.last + 1 - n.first)
                       for name, t in licenses.TEMPLATES if name == n.label) >= n.share - 1e-12


def test_other_names_give_no_label(docs_of):
    texts = ["Released under the ACME License.", "Licensed under the Mozilla License, Version 2.0.", "Licensed under CC BY 4.0.",
             "Redistribution of goods is permitted", "Licensed under CC BY-NC-SA 4.0."]
    got = scan(docs_of(list(enumerate(texts))))
    assert [got[i].labels for i in range(5)] == ["", "", "cc-by", "", "cc-by-nc-sa"]
    assert [got[i].score for i in (0, 2)] == [0.0, 1.0]


def test_common_words_equals_table():
    r = random.Random(7)
    for _ in range(300):
        a, b = ([r.choice(b"a b c d".split()) for _ in range(r.randint(0, 30))] for _ in range(2))
        assert licenses.common_words(a, b) == subsequence(a, b)


def test_edges(edges, docs_of):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.labels, r.score) for r in licenses.scan(edges).collect())
    assert [g[1:3] for g in got if not g[0]] == [(1, 0), (2, 0), (3, 0), (4, 1), (5, 6), (5, 6), (7, 7), (8, 30_000)]
    assert got[-1][2] == 5 and {g[3] for g in got} == {""} and {g[4] for g in got} == {0.0}
    assert licenses.scan(edges.filter("false")).count() == 0
    same = docs_of([(1, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "nothing"), (None, "Licensed under CC BY 4.0")])
    assert sorted((str(r.doc_id), r.labels) for r in licenses.scan(same).collect()) == [("1", ""), ("1", "mit"), ("1", "mit"), ("None", "cc-by")]


@pytest.mark.parametrize("many", [3000])
def test_repeated_notice_in_one_text(docs_of, many):
    got = scan(docs_of([(1, "Released under the MIT License. " * many)]))[1]
    assert got.n_base == many and len(got.notices) == many and got.last_word == 5 * many - 2
