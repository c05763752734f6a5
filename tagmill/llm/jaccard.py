"""N-gram Jaccard join with adaptive multi-match prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm import graph
from tagmill.llm.common import staged
from tagmill.llm.text import WordHashes, shingle_set
from tagmill.session import broadcast_if_small

WIDTH, PERCENT = 5, 75
# Cells of the frequency sketch (fixed, whatever the corpus) and how many travel in one row.
CELLS, CELLS_PER_ROW = 1 << 18, 1 << 10
MOST_LEVELS = 8
# Cells of a set's bitmap for each shingle, before rounding up to a power of two.
BITS_PER_SHINGLE = 4
# Postings that a task gathers before it packs them, and that a bucket of shingles holds.
PER_BUCKET = 1 << 20


def _needed(sizes: np.ndarray | int, percent: int):
    """Shingles a set must share with any set it is similar to."""
    return (percent * sizes + 99) // 100


def _profiles(width: int, cells: int, per_row: int):
    """Per document its set's size and digest; per task also rows of the frequency sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, counts = WordHashes(), set(), np.zeros(cells, np.uint32)
        names = ["doc_id", "n", "digest", "cls", "bits", "part", "counts"]
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            sizes, digests, bits = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text or b"", width, known)
                digest = _digest(found)
                sizes.append(len(found))
                digests.append(digest)
                bits.append(_bitmap(found))
                if len(found) and digest not in seen:
                    seen.add(digest)
                    np.add.at(counts, (found & np.uint64(cells - 1)).astype(np.int64), 1)
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array([_key(d) for d in digests], pa.int64()),
                 pa.array(bits, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
        if kind is not None and counts.any():
            parts = [i for i in range(cells // per_row) if counts[i * per_row:(i + 1) * per_row].any()]
            data = [counts[i * per_row:(i + 1) * per_row].tobytes() for i in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(parts), kind), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.binary()),
                 pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.binary()), pa.array(parts, pa.int32()), pa.array(data, pa.binary())], names=names)

    return run


def _bitmap(found: np.ndarray) -> bytes:
    """Which of some four cells per shingle, a power of two, the shingles fall into."""
    cells = max(64, 1 << (BITS_PER_SHINGLE * len(found) - 1).bit_length()) if len(found) else 64
    held = np.zeros(cells, np.uint8)
    held[(found >> np.uint64(17) & np.uint64(cells - 1)).astype(np.int64)] = 1
    return np.packbits(held, bitorder="little").tobytes()


def most_common(one: bytes, two: bytes, n_one: int, n_two: int) -> int:
    """Bound of the shingles that two sets share: each cell that only one of them fills holds a shingle of its own.

    The longer bitmap is folded to the length of the other.
    """
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
    shorter = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, shorter)) for x in (a, b))
    return min(n_one - int(np.bitwise_count(a & ~b).sum()), n_two - int(np.bitwise_count(b & ~a).sum()))


def _maybe_similar(percent: int):
    """Leaves out pairs whose bitmaps show that they share too little."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("x", "y", "nx", "ny")]
            keep = [100 * o >= percent * (nx + ny - o) for (x, y, nx, ny) in zip(*columns, strict=True) for o in [most_common(x, y, nx, ny)]]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    return run


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _key(digest: bytes) -> int:
    """Half a digest; together with the set's size it stands for a class while shingles are counted."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _added(kind: str):
    """Add sketch rows of equal parts as they stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(data, kind).astype(np.int64)
                if part in total:
                    total[part] += found
                else:
                    total[part] = found
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            names=["part", "counts"])

    return run


def _sketch(profiles: DataFrame, cells: int, per_row: int) -> np.ndarray:
    """How often shingles of each cell occur; of fixed size, so it may pass through the driver."""
    rows = profiles.filter(F.col("part").isNotNull()).select("part", "counts")
    # Once within partitions as they are read, once by part.
    near = rows.mapInArrow(_added("u4"), "part int, counts binary")
    total = near.repartition("part").mapInArrow(_added("i8"), "part int, counts binary")
    out = np.zeros(cells, np.int64)
    for part, data in total.collect():
        out[part * per_row:(part + 1) * per_row] += np.frombuffer(data, np.int64)
    return np.minimum(out, (1 << 24) - 1).astype(np.uint32)


def _postings(width: int, percent: int, shared, most_levels: int, buckets: int, per_bucket: int):
    """Prefix shingles of each distinct set of a task, packed by bucket of the shingle: ``bucket, data``.

    Shingles are ordered rare cells first. With level l a document sends
    ``n - needed + l`` shingles; two similar sets share at least l of them.
    The level grows with the postings the sketch expects beyond chance. A shingle whose cell alone would fill
    much of a bucket is dealt by document instead, to buckets below 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        cells = len(counts)
        chance = counts.mean() + 3.0 * np.sqrt(counts.mean()) + 1.0
        hot = per_bucket // 4 + counts.mean()
        known, seen = WordHashes(), set()
        waiting: list[tuple[np.ndarray, np.ndarray, int, int, int]] = []

        def flush() -> pa.RecordBatch:
            sizes = [len(w[0]) for w in waiting]
            tokens, often = (np.concatenate([w[i] for w in waiting]) for i in (0, 1))
            docs = np.repeat(np.arange(len(waiting)), sizes)
            places = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            classes = np.array([w[2] for w in waiting], np.int64)
            spread = (classes.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            bucket = np.where(often > hot, -1 - spread[docs], ((tokens >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64))
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order[0]] - 1))
            packets = [_packed(tokens[part], docs[part], places[part], classes, np.array([w[3] for w in waiting], np.int64),
                               np.array([w[4] for w in waiting], np.int64)) for part in np.split(order, edges[1:])]
            names = bucket[order[edges]]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packets, pa.binary())], names=["bucket", "data"])

        gathered = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingle_set(text or b"", width, known)
                n = len(found)
                digest = _digest(found)
                if doc is None or not n or digest in seen:
                    continue
                seen.add(digest)
                often = counts[(found & np.uint64(cells - 1)).astype(np.int64)]
                order = np.argsort((often.astype(np.uint64) << np.uint64(40)) | (found >> np.uint64(24)), kind="stable")
                needed = int(_needed(n, percent))
                base = n - needed + 1
                cost = float(np.maximum(often[order[:base]] - chance, 0.0).mean())
                level = max(1, min(most_levels, needed, 1 + int(np.log2(1.0 + cost) / 2)))
                chosen = order[:base + level - 1]
                waiting.append((found[chosen], often[chosen], _key(digest), n, level))
                gathered += len(chosen)
                if gathered >= per_bucket:
                    yield flush()
                    gathered = 0
        if waiting:
            yield flush()

    return run


def _packed(tokens: np.ndarray, docs: np.ndarray, places: np.ndarray, classes: np.ndarray, sizes: np.ndarray, levels: np.ndarray) -> bytes:
    """One packet of postings: its documents once, then shingles, document numbers and places by columns."""
    used, local = np.unique(docs, return_inverse=True)
    columns = (classes[used], sizes[used], levels[used], tokens.view(np.int64), local.astype(np.int64), places.astype(np.int64))
    wide = [c.view(np.uint8).reshape(-1, 8) for c in columns]
    # Bytes of equal weight lie together, so those that are 0 throughout cost little once the exchange is compressed.
    return b"".join([np.array([len(used), len(tokens)], np.int64).tobytes(), *(np.ascontiguousarray(w.T).tobytes() for w in wide)])


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, classes, meta and places of a packet; meta holds size and level."""
    docs, rows = (int(x) for x in np.frombuffer(data[:16], np.int64))
    body, at, columns = np.frombuffer(data, np.uint8), 16, []
    for many in (docs, docs, docs, rows, rows, rows):
        columns.append(np.ascontiguousarray(body[at:at + 8 * many].reshape(8, many).T).view(np.int64).ravel())
        at += 8 * many
    classes, sizes, levels, tokens, local, places = columns
    return tokens, classes[local], ((sizes << 8) | levels)[local], places


def _shared_postings(table: pa.Table) -> pa.Table:
    """Postings of a bucket whose shingle more than one class sends, each class once: ``token, cls, meta, pos``."""
    parts = [_unpacked(x.as_py()) for x in table.column("data")]
    tokens, classes, metas, places = (np.concatenate([p[i] for p in parts]) for i in range(4))
    order = np.lexsort((classes, tokens))
    tokens, classes, metas, places = tokens[order], classes[order], metas[order], places[order]
    new_token = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    first = new_token | np.concatenate([[True], classes[1:] != classes[:-1]])
    tokens, classes, metas, places, new_token = (x[first] for x in (tokens, classes, metas, places, new_token))
    run = np.cumsum(new_token) - 1
    # A bucket below 0 holds some of the classes of very frequent shingles only.
    several = (np.bincount(run)[run] > 1) | (table.column("bucket")[0].as_py() < 0)
    return pa.table([pa.array(x[several]) for x in (tokens, classes, metas, places)], ["token", "cls", "meta", "pos"])


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            found = [shingle_set(text or b"", width, known).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc", "hashes"])

    return run


def _frequent(rows: DataFrame, key: str, what: str) -> DataFrame:
    """Rows whose ``key`` occurs with more than one ``what``."""
    several = rows.groupBy(key).agg(F.min(what).alias("x"), F.max(what).alias("y")).filter("x < y").select(key)
    return rows.join(several, key, "left_semi")


def _verified(texts: DataFrame, profiles: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole shingle sets are similar enough; bitmaps leave out most others before."""
    pairs = staged(pairs.select("a", "b"), "pairs")
    maps = profiles.join(_members(pairs), "doc_id", "left_semi").select("doc_id", "n", "bits")
    seen = (pairs.join(maps.select(F.col("doc_id").alias("a"), F.col("n").alias("nx"), F.col("bits").alias("x")), "a")
            .join(maps.select(F.col("doc_id").alias("b"), F.col("n").alias("ny"), F.col("bits").alias("y")), "b"))
    pairs = staged(seen.mapInArrow(_maybe_similar(percent), "a bigint, b bigint").distinct(), "pairs")
    sets = texts.join(_members(pairs), "doc_id", "left_semi").mapInArrow(_sets(width), "doc bigint, hashes array<bigint>")
    sets = staged(sets, "sets")
    one = pairs.join(sets.select(F.col("doc").alias("a"), F.col("hashes").alias("x")), "a")
    both = one.join(sets.select(F.col("doc").alias("b"), F.col("hashes").alias("y")), "b")
    common = both.select("a", "b", F.size(F.array_intersect("x", "y")).cast("bigint").alias("o"),
                         (F.size("x") + F.size("y")).cast("bigint").alias("s"))
    return common.filter(F.col("o") * 100 >= percent * (F.col("s") - F.col("o"))).select("a", "b")


def _members(pairs: DataFrame) -> DataFrame:
    """The ids in some pairs. Only a counted number is broadcast; more are met by a join."""
    return broadcast_if_small(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct())


def _size(meta: str):
    return F.shiftright(meta, 8)


def _level(meta: str):
    return F.col(meta).bitwiseAND(255)


def _enough(times: str, percent: int, one: str, two: str):
    """Whether two prefixes share as many shingles as similar sets must.

    Of the shingles common to two sets, those not shared by the prefixes lie behind the prefix of one of them.
    So they are at most ``max(n - p)``, and the prefixes share the rest of the overlap that similarity asks for;
    where both levels are higher, at least the lower level.
    """
    def behind(meta: str):
        needed = F.floor((percent * _size(meta) + 99) / 100)
        return needed - _level(meta)

    overlap = F.ceil(percent * (_size(one) + _size(two)) / (100 + percent))
    return F.col(times) >= F.greatest(F.least(_level(one), _level(two)), overlap - F.greatest(behind(one), behind(two)))


def _needed_prefix(meta: str, percent: int):
    """Length of a document's prefix."""
    return _size(meta) - F.floor((percent * _size(meta) + 99) / 100) + _level(meta)


def _comparable(percent: int, one: str, two: str):
    return 100 * F.least(_size(one), _size(two)) >= percent * F.greatest(_size(one), _size(two))


def _stars(rows: DataFrame, percent: int, rank) -> DataFrame:
    """Per document that centre of another component it meets most often, if often enough: ``a, b``.

    The centre of a shingle's list is its document of the highest rank.
    """
    rows = rows.withColumn("rank", rank)
    centre = rows.groupBy("token").agg(F.max(F.struct("rank", (-F.col("doc")).alias("less"), "meta", "component")).alias("c"))
    met = (rows.join(centre, "token").filter("component <> c.component")
           .select("doc", "meta", (-F.col("c.less")).alias("b"), F.col("c.meta").alias("mb"))
           .filter(_comparable(percent, "meta", "mb")).groupBy("doc", "b", "meta", "mb").agg(F.count("*").alias("times")))
    return (met.filter(_enough("times", percent, "meta", "mb")).groupBy("doc").agg(F.max_by("b", F.struct("times", "b")).alias("b"))
            .select(F.col("doc").alias("a"), "b"))


def _short(meta: str, percent: int) -> Column:
    """Length of the prefix that suffices for the smaller set of a pair, which shares more of itself."""
    return _size(meta) - F.ceil(2 * percent * _size(meta) / (100 + percent)) + _level(meta)


def _possible(percent: int, one: tuple[str, str, str], two: tuple[str, str, str]) -> Column:
    """Whether sets that share a shingle may be similar, by (shared before, behind, size) of it in both.

    Both sets are in one order: what they share lies before the shingle in both or behind it in both,
    and before it only shingles that other classes have too can be shared.
    """
    most = F.least(one[0], two[0]) + 1 + F.least(one[1], two[1])
    return (100 + percent) * most >= percent * (F.col(one[2]) + F.col(two[2]))


def _crossing(mixed: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share enough prefix shingles, the larger set first: ``a, b``.

    Lists of one component are left out before, and components are paired before their members, so a large
    group of copies is never paired with itself. Every join tests by the places of the shared shingle whether
    the pair may be similar, for components by the best of their members; such a test never loses a similar pair.
    """
    whole = mixed.select("token", "component", "doc", "meta", "before", _size("meta").alias("n"),
                         (_size("meta") - F.col("pos") - 1).alias("behind"), (F.col("pos") < _short("meta", percent)).alias("short"))
    short = whole.filter("short")

    def groups(rows: DataFrame, to: str) -> DataFrame:
        return rows.groupBy("token", F.col("component").alias(to)).agg(
            F.max("before").alias(f"before_{to}"), F.max("behind").alias(f"behind_{to}"),
            F.min("n").alias(f"least_{to}"), F.max("n").alias(f"most_{to}"))

    def members(rows: DataFrame, group: str, to: str) -> DataFrame:
        return rows.select("token", F.col("component").alias(group), F.col("doc").alias(to), F.col("meta").alias(f"m{to}"),
                           F.col("before").alias(f"before_{to}"), F.col("behind").alias(f"behind_{to}"), F.col("n").alias(f"n_{to}"))

    p, q = groups(whole, "p").alias("p"), groups(short, "q").alias("q")
    a, b = members(whole, "p", "a").alias("a"), members(short, "q", "b").alias("b")
    of_p, of_q = ("before_p", "behind_p", "least_p"), ("before_q", "behind_q", "least_q")
    of_a, of_b = ("before_a", "behind_a", "n_a"), ("before_b", "behind_b", "n_b")
    paired = (p.join(q, (F.col("p.token") == F.col("q.token")) & (F.col("p") != F.col("q")) & (F.col("least_q") <= F.col("most_p"))
                     & (100 * F.col("most_q") >= percent * F.col("least_p")) & _possible(percent, of_p, of_q))
              .select(F.col("p.token").alias("token"), "p", "q", "least_q", "most_q", "before_q", "behind_q").alias("pq"))
    half = (paired.join(a, (F.col("pq.token") == F.col("a.token")) & (F.col("pq.p") == F.col("a.p")) & (F.col("least_q") <= F.col("n_a"))
                        & (100 * F.col("most_q") >= percent * F.col("n_a")) & _possible(percent, of_a, of_q))
            .select(F.col("pq.token").alias("token"), "q", "a", "ma", *of_a).alias("half"))
    ordered = F.struct("n_b", "b") < F.struct("n_a", "a")
    # Sets that share ``overlap`` shingles share ``level`` of them within the first ``n - overlap + level`` of each.
    level = F.least(_level("ma"), _level("mb"))
    overlap = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    met = half.join(b, (F.col("half.token") == F.col("b.token")) & (F.col("half.q") == F.col("b.q")) & ordered
                    & (100 * F.col("n_b") >= percent * F.col("n_a")) & _possible(percent, of_a, of_b)
                    & (F.least("behind_a", "behind_b") >= overlap - level))
    near = met.groupBy("a", "b", "ma", "mb").agg(F.count("*").alias("times"))
    return near.filter(F.col("times") >= level).select("a", "b")


def link(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, cells: int = CELLS, per_row: int = CELLS_PER_ROW,
         most_levels: int = MOST_LEVELS, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per input row; no link of similarity ``percent`` or more is lost.

    1. Each text becomes a set of 64-bit shingle hashes; equal sets form a class under its smallest id.
    2. A sketch of fixed size says which shingles are frequent; each class sends the prefix of its rarest
       shingles, longer where many candidates are expected.
    3. Prefix shingles meet once, packed by bucket; those of one class only are dropped there. Each class
       is compared with the centre it shares most with, in two rounds with different centres; that joins large
       groups by a few comparisons per member.
    4. All remaining pairs of different components that share as many prefix shingles as their sizes and
       levels ask for, at places that leave enough in common, are compared exactly. The smaller set of a pair
       needs a shorter prefix. Pairs inside a component could change nothing.

    Comparisons use whole sets; only equal 64-bit hashes of different shingles, or of different sets of one size,
    could deceive them. Rows without an id get no component; texts without words are linked with nothing. Rows that repeat an
    id are one document with several texts. Columns beyond ``doc_id, text`` are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    profiles = staged(texts.mapInArrow(_profiles(width, cells, per_row),
                                       "doc_id bigint, n bigint, digest binary, cls bigint, bits binary, part int, counts binary"), "profiles")
    shared = spark.sparkContext.broadcast(_sketch(profiles, cells, per_row))
    profiles = profiles.filter(F.col("part").isNull()).drop("part", "counts")
    rows = profiles.select("doc_id", "n", "digest", "cls")
    classes = (rows.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
               .filter("rep < last").select("digest", "rep"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))
    rows = staged(rows.join(classes, "digest", "left").select("doc_id", "n", "cls", own.alias("rep")), "classes")

    # A class's prefix is about the share of its set that similar sets may differ in.
    sent = rows.filter("n > 0").select("cls", "n").distinct().agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1)).first()[0]
    buckets = max(1, -(-(sent or 0) // per_bucket))
    packets = texts.mapInArrow(_postings(width, percent, shared, most_levels, buckets, per_bucket), "bucket bigint, data binary")
    listed = packets.groupBy("bucket").applyInArrow(_shared_postings, "token bigint, cls bigint, meta bigint, pos bigint")
    listed = listed.withColumn("n", _size("meta"))
    senders = rows.filter("n > 0 AND rep IS NOT NULL").groupBy("cls", "n").agg(F.min("rep").alias("doc"))

    # Several texts of one id hold their classes together.
    again = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a < last").select("doc_id", "a")
    links = staged(rows.join(again, "doc_id").filter("a < rep").select("a", F.col("rep").alias("b")).distinct(), "links")
    # Originals come first as centres: most of their prefix is found elsewhere, while copies have shingles of their own.
    # A window holds one document's prefix. ``before`` counts its earlier shingles that other classes list too.
    of_doc = Window.partitionBy("cls", "n")
    mixed = staged(listed.join(senders, ["cls", "n"]).withColumn("before", (F.row_number().over(of_doc.orderBy("pos")) - 1).cast("bigint"))
                   .withColumn("share", F.count("*").over(of_doc) / _needed_prefix("meta", percent))
                   .select("token", "doc", "meta", "pos", "before", "share", F.col("doc").alias("component")), "ranked")
    for turn, rank in enumerate((F.col("share"), F.xxhash64("doc"), None)):
        if turn:
            # Components only grow, so shingles that one component has to itself are gone for good.
            found = graph.components(links)
            grouped = (mixed.drop("component").join(found.select(F.col("id").alias("doc"), "component"), "doc", "left")
                       .select("token", "doc", "meta", "pos", "before", "share", F.coalesce("component", "doc").alias("component")))
            mixed = staged(_frequent(grouped, "token", "component"), "mixed")
        pairs = _crossing(mixed, percent) if rank is None else _stars(mixed, percent, rank)
        links = staged(links.union(_verified(texts, profiles, pairs, width, percent)), "links")
    final = graph.components(links)
    return (rows.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")))
