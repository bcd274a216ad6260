"""Near-duplicate documents: MinHash signatures and a multi-index Hamming join.

Every distinct shingle set gets a signature of ``CHUNKS * WIDTH`` MinHashes of
16 bits. Two signatures that differ in at most ``CHUNKS * (ERRORS + 1) - 1``
places have, by the pigeonhole principle, a chunk with at most ``ERRORS``
differing places. Each chunk is therefore indexed once for every way to leave
out ``ERRORS`` of its places: pairs under that distance always share a key.

A pair of similarity 0.8 differs in a fifth of the places on average. It shares
no key with probability 1e-5, and is farther than ``MAX_DISTANCE`` (where pairs
are no longer confirmed on their full sets) with probability 1e-5.

Keys that many documents share are never expanded into pairs:

* Equal sets become one representative first.
* Each representative goes to its *home*, the most shared of its keys or of those
  of the others that share one of its keys, so that a group of near copies has
  one home. A home is cut into tiles of bounded size. Inside a tile signatures are compared by array
  operations, pairs that are not yet connected are confirmed on their full
  sets, and only links that connect something new leave the task. The tiles of
  one home also share a few members, which connects them.
* After connected components, keys whose members are all in one component are
  done. For the rest, the pairs of tiles that share such a key are compared in
  the same way.

So no link between different components is lost, and a group of n near copies
costs n times the tile size, not n squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import handing_back, stored
from tidemark.llm.components import connected_components
from tidemark.llm.shingles import WordHashes, groups, mix, shingle_sets

CHUNKS, WIDTH, ERRORS = 5, 6, 2
MAX_DISTANCE = 16
TILE_ROWS = 1024           # representatives of a tile, on average at most
TILE_SHINGLES = 1_000_000  # and shingles
SHARED = 16                # members that all tiles of one home have

PLACES = CHUNKS * WIDTH
MASKS = [keep for keep in combinations(range(WIDTH), WIDTH - ERRORS)]


def _multipliers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """16-bit MinHashes (one row a set) of non-empty sets laid out in ``flat``."""
    out = np.zeros((len(offsets) - 1, PLACES), np.uint16)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        with np.errstate(over="ignore"):
            for k, m in enumerate(_multipliers()):
                out[full, k] = mix(np.minimum.reduceat(flat * m, offsets[:-1][full])) & np.uint64(0xFFFF)
    return out


def _sets(batches, shingle: int):
    """For each group of rows: ids, sets, offsets, signatures."""
    known = WordHashes()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        done = 0
        for group in groups(texts):
            flat, offsets = shingle_sets(group, shingle, known)
            yield ids[done:done + len(group)], flat, offsets, signatures(flat, offsets)
            done += len(group)


# what a row is told apart by: its id and two hashes of its text
_ROW = pa.struct([("doc_id", pa.int64()), ("mark", pa.int64()), ("check", pa.int32())])
ROW = "struct<doc_id:bigint,mark:bigint,check:int>"


def _features_task(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for ids, flat, offsets, sigs in _sets(batches, shingle):
            raw, cuts = flat.tobytes(), (offsets * 8).tolist()
            digests = [xxh3_128_digest(raw[a:b]) if b > a else None for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(ids, _ROW), "n_shingles": pa.array(np.diff(offsets)),
                "digest": pa.array(digests, pa.binary()), "sig": pa.array([s.tobytes() for s in sigs], pa.binary())})

    return run


def _sets_task(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flat, offsets, sigs in _sets(batches, shingle):
            raw, cuts = flat.tobytes(), (offsets * 8).tolist()
            yield pa.RecordBatch.from_pydict({
                "rep": pa.array(ids, pa.int64()), "sig": pa.array([s.tobytes() for s in sigs], pa.binary()),
                "shingles": pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())})

    return run


def _keys_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    odd = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            reps = part.column(0).to_numpy()
            sigs = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, PLACES).astype(np.uint64)
            keys = []
            with np.errstate(over="ignore"):
                for c in range(CHUNKS):
                    for k, keep in enumerate(MASKS):
                        h = np.full(len(reps), c * len(MASKS) + k + 1, np.uint64)
                        for p in keep:
                            h = h * odd + sigs[:, c * WIDTH + p]
                        keys.append(mix(h).view(np.int64))
            yield pa.RecordBatch.from_pydict({"key": np.concatenate(keys), "rep": np.tile(reps, len(keys))})


def _tile_links(rows: list[dict], percent: int) -> Iterator[tuple[int, int]]:
    """Links that connect components of one tile. Rows of side 0 meet all
    others, rows of side 1 only those of side 0."""
    rows.sort(key=lambda r: (r["side"], r["rep"]))
    reps = [r["rep"] for r in rows]
    root = np.array([r["component"] for r in rows], np.int64)
    sigs = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint16).reshape(-1, PLACES)
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    sizes = np.array([len(s) for s in sets], np.int64)
    first = [r["side"] for r in rows]
    cut = first.index(1) if first[-1] else len(rows)
    for i in range(cut):
        lo = cut if cut < len(rows) else i + 1
        near = (sigs[lo:] != sigs[i]).sum(1, dtype=np.uint8) <= MAX_DISTANCE
        low, high = np.minimum(sizes[lo:], sizes[i]), np.maximum(sizes[lo:], sizes[i])
        at = lo + np.flatnonzero(near & (root[lo:] != root[i]) & (100 * low >= percent * high))
        if not len(at):
            continue
        own = sets[i]
        other = np.concatenate([sets[j] for j in at])
        found = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
        both = np.add.reduceat(found, np.append(0, np.cumsum(sizes[at])[:-1]), dtype=np.int64)
        for j in at[100 * both >= percent * (sizes[i] + sizes[at] - both)]:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                yield reps[i], reps[j]


def _tiles_task(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, []

        def links():
            found = list(_tile_links(rows, percent)) if len(rows) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()),
                                               "b": pa.array([y for _, y in found], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["t1"], row["t2"])
                if key != tile:
                    yield links()
                    tile, rows = key, []
                rows.append(row)
        yield links()

    return run


def _links(tiles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside tiles; ``tiles`` has t1, t2, side, rep, component."""
    return (tiles.join(sets, "rep").repartition("t1", "t2").sortWithinPartitions("t1", "t2")
            .mapInArrow(handing_back(_tiles_task(percent)), "a long, b long"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``df``.

    Texts are linked when their sets of distinct ``shingle``-word shingles have
    100 * intersection >= ``percent`` * union; words are runs without ASCII
    white space, A-Z lowered. component_id is the smallest doc_id reachable over
    links, kept marks that document.

    Defined cases: a text with fewer words is one shingle; a null text or one
    without words has the empty set and is linked with nothing. Equal rows
    share a component and are all kept if one is. Rows are linked by their
    texts, whatever their ids: a row without an id links what is near it on
    both sides, and two texts under one id are two documents. A row without an
    id takes the component of its text; if no id is reachable, component_id is
    null and kept is true. An empty table gives no rows. Other columns are not
    read.
    """
    return grouped(df, id_col, text_col, shingle, percent).select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def marked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` plus __row, which tells its rows apart by id and text."""
    text = F.col(text_col).cast("string")
    return df.withColumn("__row", F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"),
                                           F.hash(text).alias("check")))


def rows_of(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """``df`` (with __row) joined with ``wanted`` (row, repeated, and more):
    each wanted row once. Only those that are marked as repeated are
    deduplicated, with a map-side aggregate."""
    keys = ["__w_id", "__w_mark", "__w_check"]
    w = wanted.select(F.col("row.doc_id").alias("__w_id"), F.col("row.mark").alias("__w_mark"),
                      F.col("row.check").alias("__w_check"), *[c for c in wanted.columns if c != "row"])
    found = df.join(w.hint("shuffle_hash"), (F.col("__row.mark") == F.col("__w_mark")) & (F.col("__row.check") == F.col("__w_check"))
                    & F.col("__row.doc_id").eqNullSafe(F.col("__w_id")))
    columns = [c for c in found.columns if c not in ("__row", "repeated", *keys)]
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    # grouped by the keys of the wanted side, so that both branches read one shuffle of ``df``
    once = found.where("repeated").groupBy(*keys).agg(F.first(whole).alias("__first")).select("__first.*")
    return found.where("not repeated").select(*[F.col(f"`{c}`") for c in columns]).unionByName(once)


def grouped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, row, component, component_id) for every row of ``df``:
    ``row`` as ``marked`` gives it, ``component`` a number of the group that is
    null for an empty set, ``component_id`` its smallest id. See
    ``near_duplicates``.

    Classes of equal sets are numbered, and everything between works on these
    numbers, so that neither a missing nor a shared id hides or makes a link.
    """
    docs = marked(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    features = stored(docs.select("__row", "text").mapInArrow(
        handing_back(_features_task(shingle)), f"row {ROW}, n_shingles long, digest binary, sig binary"), "dup-features")
    first = F.struct(F.col("row.doc_id").isNull().alias("no_id"), "row")
    classes = (features.where("digest is not null").groupBy("digest")
               .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"), F.first("sig").alias("sig")))
    classes = stored(classes.select("digest", "sig", F.col("first.row").alias("row"), (F.col("n") > 1).alias("repeated"))
                     .withColumn("rep", F.monotonically_increasing_id()), "dup-classes")
    keys = classes.select("rep", "sig").mapInArrow(handing_back(_keys_task), "key long, rep long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(keys.join(shared, "key"), "dup-members")

    homes = stored(members.groupBy("rep").agg(F.max(F.struct("n", "key")).alias("h"))
                   .select("rep", F.col("h.key").alias("home")), "dup-homes")
    # move on to the most lived-in home among those one shares a key with
    lived = homes.join(homes.groupBy("home").agg(F.count(F.lit(1)).alias("n")), "home").select(
        "rep", F.struct("n", "home").alias("h"))
    best = members.select("key", "rep").join(lived, "rep").groupBy("key").agg(F.max("h").alias("h"))
    homes = stored(members.select("key", "rep").join(best, "key").groupBy("rep").agg(F.max("h").alias("h"))
                   .select("rep", F.col("h.home").alias("home")), "dup-homes")
    texts = rows_of(docs.select("text", "__row"), classes.join(homes.select("rep"), "rep").select("row", "repeated", "rep"))
    sets = stored(texts.select("rep", "text").mapInArrow(
        handing_back(_sets_task(shingle)), "rep long, sig binary, shingles binary"), "dup-sets")
    sizes = sets.groupBy("rep").agg(F.max(F.length("shingles") / 8).alias("size"))
    tiles = homes.join(sizes, "rep")
    cuts = tiles.groupBy("home").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / F.lit(float(TILE_ROWS)), F.sum("size") / F.lit(float(TILE_SHINGLES)))).alias("cuts"))
    place = F.xxhash64("rep")
    placed = stored(tiles.join(cuts, "home").select(
        "rep", "home", "cuts", F.pmod(place, F.col("cuts")).alias("cut")), "dup-tiles")
    # the members that all tiles of a cut home have: the smallest few by hash
    several = placed.where("cuts > 1")
    lowest = several.groupBy("home", "cut").agg(F.min(F.struct(place.alias("h"), "rep", "cuts")).alias("m"))
    common = (several.join(lowest.groupBy("home").agg(
        F.slice(F.array_sort(F.collect_list("m.rep")), 1, SHARED).alias("reps")), "home")
        .select("home", "cuts", F.explode("reps").alias("rep")).distinct()
        .select("rep", "home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut")))
    own = placed.select("rep", "home", "cut").union(common).distinct()
    links = stored(_links(own.select(F.col("home").alias("t1"), F.col("cut").alias("t2"), F.lit(0).alias("side"),
                                     "rep", F.col("rep").alias("component")), sets, percent), "dup-links")

    found = connected_components(links)
    placed = placed.select("rep", F.xxhash64("home", "cut").alias("tile"))
    placed = stored(placed.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                    .withColumn("component", F.coalesce("component", "rep")), "dup-placed")
    spread = (members.join(placed, "rep").groupBy("key", "tile")
              .agg(F.min("component").alias("low"), F.max("component").alias("high")))
    open_keys = (spread.groupBy("key").agg(F.min("low").alias("l"), F.max("high").alias("h"),
                                           F.count(F.lit(1)).alias("n")).where("l < h and n > 1").select("key"))
    open_tiles = stored(spread.join(open_keys, "key"), "dup-open")
    x, y = open_tiles.alias("x"), open_tiles.alias("y")
    met = stored(x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.tile") < F.col("y.tile"))
                        & (F.least("x.low", "y.low") < F.greatest("x.high", "y.high")))
                 .select(F.col("x.tile").alias("t1"), F.col("y.tile").alias("t2")).distinct(), "dup-met")
    sides = (met.select("t1", "t2", F.lit(0).alias("side"), F.col("t1").alias("tile"))
             .union(met.select("t1", "t2", F.lit(1).alias("side"), F.col("t2").alias("tile"))))
    # only members with an open key take part
    active = placed.join(members.join(open_keys, "key", "left_semi").select("rep").distinct(), "rep", "left_semi")
    late = stored(_links(sides.join(active, "tile").select("t1", "t2", "side", "rep", "component"), sets, percent),
                  "dup-late-links")
    found = connected_components(links.union(late))

    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", "row", F.coalesce("component", "rep").alias("component"))
    named = stored(named, "dup-named")
    smallest = named.groupBy("component").agg(F.min("row.doc_id").alias("component_id"))
    named = named.drop("row").join(smallest, "component")
    return features.select(F.col("row.doc_id").alias("doc_id"), "n_shingles", "row", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles", "row", "component", "component_id")
