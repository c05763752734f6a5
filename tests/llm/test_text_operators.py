"""Operators on training text against brute force on small inputs, and edge cases of every one."""

import base64
import collections
import hashlib
import random
import re
import tracemalloc
import zipfile

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tagmill.llm import bpe, graph, jaccard, langid, lines, mixture, rules, secrets, templates, vectors, warc
from tagmill.llm.common import ready
from tagmill.llm.queries import PATTERN, RANKS

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def text_of(random_, n):
    return " ".join(random_.choice(WORDS) for _ in range(n))


def test_bpe_equals_library(docs_of, edges):
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(RANKS))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    rows = [(i, "".join(r.choice("abet hs\n\t's 12é漢🙂.-") for _ in range(r.randint(0, 80)))) for i in range(300)]
    rows += [(1000, "a" * 50_000), (1001, None), (1002, "<|endoftext|>")]
    got = {x[0]: x[1] for x in bpe.encode(docs_of(rows), RANKS, PATTERN).collect()}
    assert all(list(got[i] or []) == library.encode_ordinary(t or "") for i, t in rows)
    back = {x[0]: bytes(x[1]) for x in bpe.decode(bpe.encode(docs_of(rows), RANKS, PATTERN), RANKS, PATTERN).collect()}
    assert all(back[i] == (t or "").encode() for i, t in rows)
    for row in bpe.digests(edges, RANKS, PATTERN).filter("doc_id = 7").collect():
        ids = library.encode_ordinary("Ünïcödé wörds 漢字 🙂 #tag\nline\nline")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.digests(edges.filter("false"), RANKS, PATTERN).count() == 0


def test_bpe_memos_stay_small():
    plain = bpe.Tables([bytes([i]) for i in range(256)]).plain()
    codec = bpe.Codec(plain, r"\S+")
    tracemalloc.start()
    for i in range(300_000, 690_000, 1000):
        codec.encode(" ".join(map(str, range(i, i + 1000))))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 50 << 20


def test_bpe_ids_do_not_depend_on_memos(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 8)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 4)
    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranks)}, special_tokens={})
    r = random.Random(5)
    parts = ["".join(r.choice("abetsé漢 ") for _ in range(r.randint(2, 12))) for _ in range(30)]
    texts = ["".join(r.choices(parts, k=40)) for _ in range(100)]
    # Vocabularies of more than 2^16 tokens pack their ids wider.
    grown = [*ranks, *(b"\0\1" + str(i).encode() for i in range(1 << 16))]
    for tokens in (ranks, grown):
        plain = bpe.Tables(tokens).plain()
        codec = bpe.Codec(plain, PATTERN)
        for text in texts:
            ids = codec.encode(text)
            assert ids == library.encode_ordinary(text) and codec.decode(ids) == text.encode()
            assert len(codec.known) + len(codec.older) <= 8 and len(codec.fits) <= 4
    assert bpe.Codec(plain, r"(?s).+").encode("\0\x0165535") == [len(ranks) + 65535]

def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_jaccard_equals_brute_force(docs_of):
    r = random.Random(5)
    rows, i = [], 0
    for _ in range(12):
        base = text_of(r, r.randint(8, 120)).split()
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = f"w{r.randint(0, 9999)}"
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(500, None), (501, ""), (502, "A b"), (503, "a B"), (504, "b a")]
    sets = {i: shingles(t) for i, t in rows}
    part = {i: i for i in sets}

    def root(x):
        return x if part[x] == x else root(part[x])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                part[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(docs_of(rows)).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in sets}


def test_jaccard_in_many_small_and_hot_buckets(docs_of):
    r = random.Random(8)
    base = text_of(r, 60).split()
    rows = [(i, " ".join([*base[:40], *(f"v{r.randint(0, 3)}" for _ in range(i % 9))])) for i in range(90)]
    rows += [(200 + i, text_of(r, r.randint(3, 40))) for i in range(60)]
    docs = docs_of(rows).repartition(5)
    want = sorted(map(tuple, jaccard.link(docs).collect()))
    assert len({w[2] for w in want}) < 80
    for settings in ({"per_bucket": 16}, {"per_bucket": 64, "cells": 64, "per_row": 16}):
        assert sorted(map(tuple, jaccard.link(docs, **settings).collect())) == want


def test_postings_packets_round_trip():
    r = np.random.default_rng(1)
    tokens = r.integers(0, 2**64 - 1, 50, dtype=np.uint64)
    docs = np.sort(r.integers(0, 6, 50))
    classes, sizes, levels = r.integers(-2**63, 2**63 - 1, 6), r.integers(1, 2**40, 6), r.integers(1, 9, 6)
    got = jaccard._unpacked(jaccard._packed(tokens, docs, np.arange(50), classes, sizes, levels))
    assert np.array_equal(got[0], tokens.view(np.int64)) and np.array_equal(got[1], classes[docs])
    assert np.array_equal(got[2], (sizes[docs] << 8) | levels[docs]) and np.array_equal(got[3], np.arange(50))


def test_jaccard_edges(edges):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.link(edges).collect())
    assert [g[1:] for g in got if not g[0]] == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 2, 5), (5, 2, 5), (7, 3, 7), (8, 1, 8)]
    assert got[-1][3] is None
    assert jaccard.link(edges.filter("false")).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    ready(spark)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_mixture_meets_targets(docs_of):
    r = random.Random(1)
    rows = docs_of([(i, text_of(r, r.randint(1, 40))) for i in range(900)])
    rows = rows.withColumn("source", F.when(F.col("doc_id") < 700, "a").when(F.col("doc_id") < 850, "b").when(F.col("doc_id") < 890, "c"))
    got = mixture.mix(rows).toPandas()
    assert len(got) == 900 and (got.taken <= 2 * got["size"]).all()
    for target, group in got.groupby("target"):
        assert abs(group.taken.sum() - target) <= 20 and target <= 2 * group.source_size.iloc[0]
    again = mixture.mix(rows.repartition(3)).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    mixed = mixture.apply(rows).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    copies = got.set_index("doc_id")
    assert all(mixed.get(i, 0) * copies.loc[i, "size"] == copies.loc[i, "taken"] for i in copies.index)


def test_mixture_edges(edges):
    got = mixture.mix(edges).collect()
    assert len(got) == 9 and sum(r["size"] for r in got) == got[0].source_size
    assert mixture.mix(edges.filter("false")).count() == 0


def slow_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines_ = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines_) - len(set(lines_)), len(covered))


def test_rules_equal_brute_force(docs_of, edges):
    r = random.Random(2)
    texts = [(i, "\n".join(text_of(r, r.randint(0, 9)) + r.choice(["", " # *", " x", "é漢\x85"]) for _ in range(r.randint(0, 30))))
             for i in range(150)] + [(900, "a " * 80), (901, None)]
    for row in rules.judge(docs_of(texts)).collect():
        want = slow_measures(dict(texts)[row.doc_id])
        assert tuple(row)[1:6] == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row.base_failed and row.kept)
    assert rules.judge(edges).count() == 9
    assert rules.judge(edges.filter("false")).count() == 0


def test_rules_adapt_to_their_group(docs_of):
    r = random.Random(4)
    plain = [(i, " ".join(f"w{r.randint(0, 10**6)}" for _ in range(100))) for i in range(300)]
    odd = [(1000, " ".join(f"w{r.randint(0, 10**6)} #" for _ in range(100)))]
    kept = {x.doc_id: x.kept for x in rules.judge(docs_of(plain + odd)).collect()}
    assert not kept.pop(1000) and all(kept.values())


def test_rules_reject_the_junk_of_a_hot_source(docs_of):
    r = random.Random(6)

    def text(symbols, n=100):
        return " ".join(f"w{r.randint(0, 10**6)}" + "#" * (i < symbols) for i in range(n))

    parts, at = [], 0
    for source, rows in (("a", [0] * 150), ("b", [0] * 150), ("c", [4 * (i % 2) for i in range(150)]), ("hot", [0] * 400 + [90] * 300)):
        parts.append(docs_of([(at + i, text(x)) for i, x in enumerate(rows)], source=source))
        at += len(rows)
    docs = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    kept = {x.doc_id: x.kept for x in rules.judge(docs).collect()}
    assert all(kept[i] for i in range(850)) and not any(kept[i] for i in range(850, 1150))
    bounds = {x.source: x.max_symbol_share for x in rules.thresholds(rules.sketch(rules.measure(docs))).collect()}
    assert bounds["a"] < bounds["c"] and bounds["hot"] < 0.1


def test_rules_bound_the_number_of_words(docs_of):
    r = random.Random(7)
    rows = [(i, " ".join(f"w{r.randint(0, 10**6)}" for _ in range(100 if i else 5000))) for i in range(300)]
    kept = {x.doc_id: x.kept for x in rules.judge(docs_of(rows)).collect()}
    assert not kept.pop(0) and all(kept.values())


def test_secret_patterns_and_whole_text(docs_of, edges):
    text = ("é password=abcdefghijkl1 and Api_Key : 'short' AKIAABCDEFGHIJKLMN " + "x " * 1000 + "0123456789abcdef0 TOKEN=\"zzzzzzzzzzzzz\" AKIA12")
    rows = [(i, text_of(random.Random(i), 60) + (f" secret={i:020x} " if i % 3 == 0 else "")) for i in range(60)]
    got = {r.doc_id: r for r in secrets.scan(docs_of([*rows, (100, text), (101, None), (102, "")])).collect()}
    row = got[100]
    assert (row.n_assign, row.n_access, row.n_hex) == (2, 1, 1)
    base = ",".join(s for s in row.spans.split(",") if not s.startswith("crf"))
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    kind, start, end = base.split(",")[0].split(":")
    assert (kind, text[int(start):int(end)]) == ("assign", "password=abcdefghijkl1")
    assert got[101].spans == got[102].spans == "" and got[1].spans == ""
    clean = {r.doc_id: r.text for r in secrets.redact(docs_of([*rows, (101, None)])).collect()}
    assert clean[101] is None and clean[1] == rows[1][1] and "0000000" not in clean[0] and "[SECRET]" in clean[0]
    assert secrets.scan(edges).count() == 9 and secrets.scan(edges.filter("false")).count() == 0


def test_pruned_decoding_is_viterbi():
    random_ = np.random.default_rng(0)
    shapes = {"own": (secrets.CLASSES + 1, 3), "before": (secrets.CLASSES + 1, 3), "after": (secrets.CLASSES + 1, 3),
              "file": (secrets.FILES, 3), "moves": (3, 3)}
    for _ in range(40):
        weights = {k: random_.normal(size=s) * 2 for k, s in shapes.items()}
        weights["own"][:, 0] += 2
        tagger, own = secrets.Tagger(weights), random_.integers(0, secrets.CLASSES, 30).astype(np.int16)
        padded = np.concatenate([[secrets.EDGE], own, [secrets.EDGE]])
        emission = weights["own"][own] + weights["before"][padded[:-2]] + weights["after"][padded[2:]] + weights["file"][1]
        want = np.array(secrets._viterbi(emission, weights["moves"], -1, -1))
        places, tags = tagger.tags(own, 1)
        found = np.zeros(30, int)
        found[places] = tags
        assert (found == want).all()


def test_language_codes_and_prediction(docs_of, edges, spark):
    for n in (2, 4, 5, 9):
        words = langid.codewords(n)
        assert len({tuple(w) for w in words}) == n
    r = random.Random(1)
    rows = docs_of([(i, text_of(r, 30)) for i in range(120)]).unionByName(
        docs_of([(i, " ".join(r.choice(["äpfel", "größe", "straße", "über", "möchte"]) for _ in range(30))) for i in range(200, 320)], lang="de"))
    got = langid.identify(rows).toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert len(held) > 40 and (held.lang_pred == np.where(held.index < 200, "en", "de")).mean() > 0.95
    edge = {x.doc_id: x for x in langid.identify(edges).collect()}
    assert edge[1].lang_pred == edge[2].lang_pred == edge[3].lang_pred == "und" and edge[1].score == 0
    assert langid.identify(edges.filter("false")).count() == 0


def test_line_quality(docs_of, edges, spark):
    r = random.Random(2)
    good = [(i, "\n".join(text_of(r, 12) for _ in range(r.randint(1, 6)))) for i in range(150)]
    bad = [(i, "\n".join(["SPAM!! " * 12] * r.randint(1, 6))) for i in range(200, 350)]
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i, _ in good + bad] + [(None, 1, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    got = lines.classify(docs_of(good + bad), labels).toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert (held.predicted == (held.index < 200)).mean() > 0.95 and got.score.between(0, 1).all()
    assert lines.classify(edges, labels).count() == 9
    assert lines.classify(edges, labels.filter("false")).count() == 9
    assert lines.accepted(docs_of(good), labels).columns == docs_of(good).columns


def test_line_fields_together_equal_alone():
    r = np.random.default_rng(0)
    weights, moves = r.normal(size=3 * lines.FEATURES), r.normal(size=(2, 2))
    texts = [b"", b"Abc def\n\nXX!! YY!!\nabc abc abc", b"\n \n", b"one\ntwo\nthree # $ 5"]
    together = lines.bad_shares(texts, weights, moves)
    for text, value in zip(texts, together, strict=True):
        _, size, shares = lines.line_shares([text])
        bad, _ = lines.marginals(lines.neighbours(lines.features(shares)) @ weights, moves)
        size = np.maximum(size, 1e-9)
        assert value == pytest.approx((bad * size).sum() / size.sum())


def test_warc_round_trip(spark, tmp_path):
    ready(spark)
    rows = [(3, "http://a/x", "same"), (1, "http://a/y\r\nz", "same"), (2, None, None), (9, "", ""), (5, "u", "é\r\n\r\n漢" * 1000), (1, "d", "same")]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id bigint, url string, html string, digest string")
    got = sorted((tuple(r) for r in warc.round_trip(pages, f"file://{tmp_path}/p").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)

    def digest(t):
        return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()

    want = [(i, len((t or "").encode()), digest(t), "revisit" if i in (3, 9) else "response", {3: 1, 9: 2}.get(i)) for i, _, t in rows]
    assert got == sorted(want, key=str)
    listed = warc.list_packages(spark, f"file://{tmp_path}/p")
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.read_records(listed).collect() if r.payload is not None}
    assert payloads[5] == rows[4][2] and payloads[1] == "same"
    assert warc.round_trip(pages.filter("false")).count() == 0


def test_zip64_directory(tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i in range(70_000):
            z.writestr(f"f{i}", b"")
        with z.open("archive/data", "w", force_zip64=True) as member:
            member.write(b"content")
        z.comment = b"PK\5\6 a comment that looks like an end"
    data = path.read_bytes()
    members = warc.directory(lambda offset, length: data[offset:offset + length], len(data))
    assert len(members) == 70_001
    method, local, packed, full = members["archive/data"]
    start = warc.content_offset(lambda offset, length: data[offset:offset + length], local)
    assert (method, data[start:start + packed], full) == (0, b"content", 7)


def test_vectors_equal_brute_force(spark):
    ready(spark)
    r = np.random.default_rng(1)
    points = []
    for _ in range(8):
        centre = r.normal(size=16)
        points += [(centre + r.normal(size=16) * s).tolist() for s in r.uniform(0, 0.6, 25)]
    points += [points[0], points[0], None, [0.0] * 16, [float("nan")] * 16, [], [None] * 16, [1.0, 2.0], [1.0, 2.1]]
    rows = spark.createDataFrame([(i, p, 0) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>, label int")
    full = [p for p in points[:202]]
    x = vectors.unit(np.array(full))
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    got = vectors.link(rows, block=16).toPandas().set_index("vec_id").sort_index()
    assert (got.n_links.to_numpy()[:202] <= linked.sum(1)).all()
    assert got.n_links[:202].sum() >= 0.9 * linked.sum()
    assert got.n_links.loc[202:206].sum() == 0 and got.n_links.loc[207:208].tolist() == [1, 1]
    assert (got.kept == (got.component_id == got.index)).all()
    assert vectors.link(rows.filter("false")).count() == 0


def test_vectors_find_small_groups_beside_a_hot_family(spark):
    ready(spark)
    r = np.random.default_rng(7)
    single = vectors.unit(r.normal(size=(2400, 32)))
    hot = vectors.unit(single[:1] + r.normal(size=(600, 32)) * 0.02)
    near = vectors.planted(single[1:601], 0.91)
    full = np.concatenate([single, hot, near])
    index = vectors.Index(full, len(full), 0.9, 0.995)
    cells = vectors.visits(full, index.first, index.second, index.many)
    a, b = cells[1:601], cells[3000:]
    assert ((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)).mean() >= 0.99
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(full)], "vec_id bigint, embedding array<double>")
    got = vectors.link(rows).filter("vec_id >= 3000").toPandas()
    assert (got.n_links >= 1).mean() >= 0.99 and (got.component_id < 3000).mean() >= 0.99


def test_each_query_weighs_the_same_in_calibration():
    # 99 queries find their one neighbour in the 5th cell; the hot one has a million links in its own cell.
    counts = np.array([(0, 3, 1, 10**6)] + [(i, 0, 5, 1) for i in range(1, 100)])
    assert vectors.visits_needed(counts, 8, 0.995) == 5
    assert vectors.visits_needed(np.array([(i, 0, 9, 1) for i in range(100)]), 8, 0.995) > 8


def test_visits_are_the_nearest_cells():
    r = np.random.default_rng(8)
    points, first, second = r.normal(size=(50, 8)), r.normal(size=(9, 4)), r.normal(size=(7, 4))
    total = vectors.distances(points[:, :4], first)[:, :, None] + vectors.distances(points[:, 4:], second)[:, None, :]
    want = np.argsort(total.reshape(50, -1), axis=1)
    for many in (1, 5, 20, 63, 100):
        assert (vectors.visits(points, first, second, many) == want[:, :many]).all()


def test_url_rules(spark):
    ready(spark)
    urls = ["http://A.example.NET/en/1", "http://example.net/de/1?x=/en/", "https://net", "https://x.org/fr/a", "http://sub.example.com/de/2#q",
            "nothing", None, "http://notexample.com/de/", "http://h:80?x", "http://a.com/b/c/d/e/f/g", ""]
    pages = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(urls)], "page_id bigint, url string, html string, template string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in templates.judge(pages).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[1] == ("example.net", "/de/1", "net/", "block")
    assert got[2] == ("net", "", None, "allow") and got[3][2:] == ("org/fr/", "allow") and got[4][2:] == ("example.com/de/", "block")
    assert got[5] == got[6] == ("", "", None, "allow") and got[7][2] is None and got[8][:2] == ("h:80", "")
    assert len(got) == len(urls) and templates.judge(pages.filter("false")).count() == 0


def _judged(spark, tmp_path, urls):
    """Verdicts and templates by page, which have to agree with the SQL."""
    pages = spark.createDataFrame([(i, u, "", "x") for i, u in enumerate(urls)], "page_id bigint, url string, html string, template string")
    got = sorted(tuple(r) for r in templates.judge(pages).collect())
    path = str(tmp_path / "pages")
    pages.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    assert got == sorted(con.execute(templates.sql()).fetchall())
    return {r[0]: (r[4], r[5]) for r in got}


def test_templates_tell_deep_branches_apart(spark, tmp_path):
    """Deep sections differ; similar inner branches are one; a segment may be called like a mark of the tree."""
    ready(spark)
    deep = [f"http://a.com/p/q/{side}/r/{i}" for side in ("good", "bad") for i in range(30)]
    rules = (("block", "a.com", "/p/q/bad/r/1"), ("allow", "a.com", "/p/q/good"))
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(deep)], "page_id bigint, url string")
    got = {deep[r.page_id]: (r.verdict, r.template) for r in templates.judge(pages, rules).collect()}
    assert got["http://a.com/p/q/good/r/2"] == ("allow", "/p/q/good/r/*") and got["http://a.com/p/q/bad/r/2"] == ("block", "/p/q/bad/r/*")
    many = [f"http://www.example.com/{lang}/x/{k}/{i}" for lang in ("en", "fr", "(merged)", "**", "*") for k in "ab" for i in range(12)]
    many += [f"http://www.example.com/de/x/{k}/{i}" for k in "ab" for i in range(40)] + ["http://www.example.com/de/x", "http://www.example.com/de"] * 6
    many += ["http://b.org/" + "/".join("s" * 3000)] + ["http://b.org/" + "d/" * n for n in range(12)] * 2 + [None, "", "x", "http://b.org"]
    found = _judged(spark, tmp_path, many)
    assert all(found[i][0] == ("block" if u and "/de/" in u else "allow") for i, u in enumerate(many) if u and "example.com/" in u and u != "http://www.example.com/de")
    assert found[many.index("http://b.org/" + "/".join("s" * 3000))][1] == "/*/**"


def test_similar_branches_share_their_labels(spark, tmp_path):
    """Branches alike in their share of blocked urls are judged together, up to the host; others keep their own verdict."""
    ready(spark)
    urls = [f"http://m.org/{a}/{b}/{i}" for a in ("fr", "es") for b in ("u", "v") for i in range(20)]
    _judged(spark, tmp_path, urls + urls)
    rng = np.random.default_rng(3)
    names = ["de", "en", "fr", "it", "x1", "x2"]
    hosts = ["example.com", "a.example.com", "example.net", "k.org", "q.net"]
    mixed = [f"http://{hosts[rng.integers(5)]}/" + "/".join(names[j] for j in rng.integers(0, 6, rng.integers(0, 6))) for _ in range(1500)]
    _judged(spark, tmp_path.joinpath("second"), mixed)


def test_templates_reject_by_purity(spark):
    ready(spark)
    rows = [(i, f"http://m.example.com/de/{i}") for i in range(40)] + [(100 + i, f"http://m.example.com/en/{i}") for i in range(40)]
    rows += [(200, "http://m.example.com/De/zz")]
    got = {r.page_id: r.verdict for r in templates.judge(spark.createDataFrame([(i, u, "") for i, u in rows], "page_id bigint, url string, html string")).collect()}
    assert all(got[i] == "block" for i in range(40)) and all(got[i] == "allow" for i in range(100, 140))


def test_pipeline_on_small_table(spark, folder):
    import corpus_pipeline

    docs = ready(spark).read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs.union(docs.limit(5)), folder)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and kept.columns == docs.columns
    found = jaccard.link(kept.select("doc_id", "text"))
    assert found.filter("doc_id <> component_id").count() == 0
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 100 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_bitmaps_never_bound_below_what_sets_share():
    r = np.random.default_rng(2)
    for _ in range(300):
        n, m = (int(x) for x in r.integers(1, 400, 2))
        shared = r.integers(0, 2**64 - 1, int(r.integers(0, min(n, m) + 1)), dtype=np.uint64)
        one, two = (np.unique(np.concatenate([shared, r.integers(0, 2**64 - 1, k - len(shared), dtype=np.uint64)])) for k in (n, m))
        bound = jaccard.most_common(jaccard._bitmap(one), jaccard._bitmap(two), len(one), len(two))
        common = len(np.intersect1d(one, two))
        assert common <= bound <= min(len(one), len(two))
        if 100 * min(len(one), len(two)) >= 75 * max(len(one), len(two)):  # else the pair is not compared
            assert bound - common <= 0.5 * (min(len(one), len(two)) - common) + 8


def test_field_finds_secrets_that_the_patterns_do_not_know(spark, docs_of):
    """Trained on one half of the texts; secrets of several kinds planted in the other half are found, ordinary texts stay."""
    ready(spark)
    draw = random.Random(11)

    def text():
        return " ".join(draw.choice(WORDS) + draw.choice(["", "", ".", ",", "\n"]) for _ in range(60))

    def value(n):
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))

    known = [lambda: f"password = {value(20)}", lambda: "AKIA" + value(16).upper(), lambda: hashlib.sha1(value(9).encode()).hexdigest(),
             lambda: f"api_key: {value(32)}"]
    learn = [(i, text() + " " + draw.choice(known)() + " " + text() if i % 2 else text()) for i in range(300)]
    weights = secrets.train(docs_of(learn))
    kinds = {"bearer": "Authorization: Bearer {}", "pwd": "pwd = {}", "url": "postgres://admin:{}@db.internal/prod", "private": "private_key: {}",
             "credential": 'credential="{}"', "passphrase": "passphrase: {}"}
    planted, rows = {}, []
    for i in range(240):
        hidden, form = value(draw.randint(16, 40)), kinds[sorted(kinds)[i % 6]]
        before = text() + " " + form[:form.index("{}")]
        planted[i] = (len(before), len(before) + len(hidden))
        rows.append((i, before + hidden + form[form.index("{}") + 2:] + " " + text()))
    rows += [(1000 + i, text()) for i in range(200)]
    got = {r.doc_id: [tuple(map(int, p.split(":")[1:])) for p in r.spans.split(",") if p] for r in secrets.scan(docs_of(rows), weights).collect()}
    for place, kind in enumerate(sorted(kinds)):
        hits = [any(a <= planted[i][0] and b >= planted[i][1] for a, b in got[i]) for i in range(place, 240, 6)]
        assert sum(hits) >= 0.9 * len(hits), kind
    assert sum(bool(got[1000 + i]) for i in range(200)) <= 2


@pytest.mark.parametrize(("span", "covered"), [((0, 10), [(2, 3), (5, 12)]), ((4, 10), [(2, 6), (20, 30)]), ((4, 10), []), ((4, 10), [(0, 40)]),
                                               ((4, 10), [(0, 1), (1, 2), (4, 5), (9, 10)])])
def test_parts_outside_of_base_spans_stay(span, covered):
    left = {i for a, b in secrets.uncovered(*span, covered) for i in range(a, b)}
    assert left == set(range(*span)) - {i for a, b in covered for i in range(a, b)}
