"""N-gram Jaccard join of whole texts: a size-aware heavy-light join with exact verification.

A text becomes the set of its distinct n-word shingles (64-bit hashes). Two sets link when 100 * |A and B| >= percent * |A or B|.
Sets of equal content are one node from the start. Tokens are ordered by an estimate of their frequency (a table of 2^20
counts over all texts, so of fixed size), rarest first; every linked pair must share tokens among the first ones:

* light sets (up to a boundary size) enumerate all 2-element subsets of a prefix in which linked sets share two tokens;
* heavy sets, and light ones that are large enough to link with them, are entered into inverted lists of a shorter prefix
  in which linked sets share one token.

The boundary is the size at which the subsets of light sets would cost more than the lists they replace, from the histogram
of sizes and the estimated list lengths. Any order and any boundary give the same links.

Lists are not expanded into pairs. Every entry of a list is compared with the list's first entry only (the one whose rare tokens
are fewest); links are merged into components; only entries that are still in another component than the first one's meet the other
entries of their list, and pairs within a component never do. So a group of copies costs as many comparisons as it has members,
and no link between components is missed. Every pair is checked on whole sets. A list that the frequency table takes for
long is dealt into parts of bounded length, each with a first entry of its own, and these are compared with the first of all.

Defined results: words are split at space and control white space, A-Z are lower-cased; a text with fewer than n words is one shingle;
null, empty and blank texts have no shingles and link with nothing; rows with equal ids are separate texts, a component's id is the smallest id in
it (null ids are passed over); empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.llm.common import mix, row_chunks, saved, text_bytes, tidy, with_lookup

WORDS = 5
PERCENT = 75
#: Counters of the frequency table: 4 MB, whatever the input's size.
TABLE_BITS = 20
#: Bits that mark the sets some pair needs: 2 MB.
NODE_BITS = 24
#: The tables are combined in so many slices.
TABLE_SLICES = 64
CHUNK_BYTES = 500_000
#: A longer list is dealt into parts.
LIST_ROWS = 20_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x5851F42D4C957F2D)
_UNBASE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word and the row it belongs to."""
    data = _LOWER[data]
    apart = _SEPARATOR[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.r_[True, apart[:-1]] | first[:-1]
    after = np.r_[apart[1:], True] | first[1:]
    starts, ends = np.flatnonzero(~apart & before), np.flatnonzero(~apart & after) + 1
    # Polynomial over the word's bytes from sums over the whole chunk.
    terms = _BYTE[data] * _powers(_BASE, len(data))
    sums = np.r_[np.uint64(0), np.cumsum(terms, dtype=np.uint64)]
    value = (sums[ends] - sums[starts]) * _powers(_UNBASE, len(data))[starts]
    rows = np.searchsorted(offsets, starts, "right") - 1
    return mix(value + (ends - starts).astype(np.uint64)), rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row, sorted by row and hash, and n + 1 offsets into them."""
    n = len(offsets) - 1
    hashes, rows = word_hashes(data, offsets)
    counts = np.bincount(rows, minlength=n)
    factors = mix(np.arange(1, words + 1, dtype=np.uint64))
    found, owner = [], []
    if len(hashes) >= words:
        last = len(hashes) - words + 1
        total = np.zeros(last, dtype=np.uint64)
        for k in range(words):
            total += hashes[k : k + last] * factors[k]
        whole = rows[:last] == rows[words - 1 :]
        found.append(mix(total[whole]))
        owner.append(rows[:last][whole])
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        begin = np.cumsum(counts) - counts
        values = np.zeros(len(short), dtype=np.uint64)
        for k in range(words - 1):
            has = counts[short] > k
            values[has] += hashes[begin[short][has] + k] * factors[k]
        found.append(mix(values ^ (counts[short].astype(np.uint64) << np.uint64(56))))
        owner.append(short)
    if not found:
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    s, r = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    fresh = np.r_[True, (s[1:] != s[:-1]) | (r[1:] != r[:-1])]
    s, r = s[fresh], r[fresh]
    return s, np.searchsorted(r, np.arange(n + 1))


def fingerprints(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One number per set that depends on its members only; rows with empty sets get 0."""
    sums = np.r_[np.uint64(0), np.cumsum(mix(sets + np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)]
    size = np.diff(bounds).astype(np.uint64)
    return np.where(size > 0, mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ mix(size)), np.uint64(0)).view(np.int64)


def _chunks(batch: pa.RecordBatch, words: int):
    """(rows, sets, bounds, fingerprints) of parts of a batch."""
    data, offsets = text_bytes(batch.column("text"))
    for a, b in row_chunks(offsets, CHUNK_BYTES):
        sets, bounds = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
        yield slice(a, b), sets, bounds, fingerprints(sets, bounds)


def slot(tokens: np.ndarray) -> np.ndarray:
    """The counter of a token."""
    return (tokens >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _table_rows(counts: np.ndarray) -> list[tuple[int, bytes]]:
    parts = np.split(counts, TABLE_SLICES)
    return [(i, zlib.compress(p.tobytes(), 1)) for i, p in enumerate(parts) if p.any()]


def _profile(words: int):
    """Per row (id, node, n), and per task the counts of its tokens, as rows of one table."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TABLE_BITS, dtype=np.int32)
        for batch in batches:
            nodes, sizes = [], []
            for _, sets, bounds, node in _chunks(batch, words):
                counts += np.bincount(slot(sets), minlength=len(counts)).astype(np.int32)
                nodes.append(node)
                sizes.append(np.diff(bounds))
            rows = batch.num_rows
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes).astype(np.int32)),
                        pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                    ],
                    schema=schema,
                )
        table = _table_rows(counts)
        if table:
            k = len(table)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()),
                    pa.array([p for p, _ in table], pa.int32()), pa.array([c for _, c in table], pa.binary()),
                ],
                schema=schema,
            )

    return run


def _combined(dtype, combine):
    """Adds up (or joins) the slices of one task: a map-side combine before the one shuffle of a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts")):
                own = np.frombuffer(zlib.decompress(blob.as_py()), dtype=dtype)
                whole[part] = combine(whole[part], own) if part in whole else own
        if whole:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(whole), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in whole.values()], pa.binary())],
                ["part", "counts"],
            )

    return run


def merged_table(parts: DataFrame, size: int, dtype, combine) -> np.ndarray:
    """All tables combined into one of fixed size."""
    merge = _combined(dtype, combine)
    slices = parts.mapInArrow(merge, "part int, counts binary").repartition("part").mapInArrow(merge, "part int, counts binary")
    out = np.zeros(size, dtype=dtype)
    width = size // TABLE_SLICES
    for row in slices.collect():  # TABLE_SLICES rows of fixed size
        out[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zlib.decompress(bytes(row["counts"])), dtype=dtype)
    return out


def list_length(table: np.ndarray) -> float:
    """Estimated length of the list of a prefix token: tokens of the rarest quarter, above what chance puts into a counter."""
    order = np.sort(table[table > 0])
    if not len(order):
        return 1.0
    rare = order[: np.searchsorted(np.cumsum(order), order.sum() / 4) + 1]
    return float(max(1.0, 1.0 + (rare - np.median(order)).clip(0).mean()))


def overlap(n, m, percent: int = PERCENT):
    """The least common members of linked sets of n and m members."""
    return -(-(percent * (n + m)) // (100 + percent))


def light_prefix(n: int, percent: int = PERCENT) -> int:
    """Members among which linked sets share two, if they share two at all."""
    return min(n, n - -(-percent * n // 100) + 2)


def heavy_prefix(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def best_boundary(histogram: dict[int, int], list_entries: float, percent: int = PERCENT, largest: int = 64) -> int:
    """The light size with the least cost: subsets of light sets, and lists scanned for all sets that may meet a heavy one."""
    def cost(boundary: int) -> float:
        total = 0.0
        for n, sets in histogram.items():
            if n <= boundary:
                total += sets * math.comb(light_prefix(n, percent), 2)
            if n > boundary or 100 * n >= percent * (boundary + 1):
                total += sets * heavy_prefix(n, percent) * (1 + list_entries)
        return total

    return min(range(largest + 1), key=lambda b: (cost(b), b))


def _postings(words: int, percent: int, boundary: int, list_rows: int, table):
    """(sig, node, n, pos) of the subsets of light sets and the list entries of the others.

    A list that may be longer than ``list_rows`` is dealt into ``parts`` parts; ``part`` is the entry's.
    """
    schema = pa.schema([(c, pa.int64() if c in ("sig", "node") else pa.int32()) for c in ("sig", "node", "n", "pos", "part", "parts")])
    first, second = mix(np.array([101, 211], dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        usual = int(np.median(counts[counts > 0])) if counts.any() else 0

        def dealt(sig, who, many, pos, often):
            parts = 1 + np.maximum(often - usual, 0) // list_rows
            part = (mix(who.view(np.uint64) ^ sig) % parts.astype(np.uint64)).astype(np.int64)
            return sig, who, many, pos, part, parts

        for batch in batches:
            for _, sets, bounds, node in _chunks(batch, words):
                size = np.diff(bounds)
                owner = np.repeat(np.arange(len(size)), size)
                # Each content once per chunk, however many copies there are.
                _, once = np.unique(node, return_index=True)
                kept = np.zeros(len(size), dtype=bool)
                kept[once] = True
                sets, owner = sets[kept[owner]], owner[kept[owner]]
                often = counts[slot(sets)].astype(np.int64)
                order = np.lexsort((sets, often, owner))
                sets, often = sets[order], often[order]
                starts = np.searchsorted(owner, np.arange(len(size)))
                place = np.arange(len(sets)) - starts[owner]
                n = size[owner]
                listed = (100 * n >= percent * (boundary + 1)) & (place < n - -(-percent * n // 100) + 1)
                out = [dealt(sets[listed], node[owner[listed]], n[listed], place[listed], often[listed])]
                for k in np.unique(size[kept & (size > 1) & (size <= boundary)]):
                    rows = np.flatnonzero(kept & (size == k))
                    prefix = light_prefix(int(k), percent)
                    at = starts[rows][:, None] + np.arange(prefix)
                    i, j = np.triu_indices(prefix, 1)
                    pairs = mix(sets[at][:, i] * first + sets[at][:, j] * second).ravel()
                    rarer = np.minimum(often[at][:, i], often[at][:, j]).ravel()
                    out.append(dealt(pairs, np.repeat(node[rows], len(i)), np.full(len(pairs), k), np.zeros(len(pairs), np.int64), rarer))
                columns = [np.concatenate(c) for c in zip(*out)]
                if len(columns[0]):
                    columns[0] = columns[0].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)).cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _bit(node: np.ndarray) -> np.ndarray:
    return (mix(node.view(np.uint64)) >> np.uint64(64 - NODE_BITS)).astype(np.int64)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit per number in any column, as slices of packed bits."""
    bits = np.zeros(1 << NODE_BITS, dtype=bool)
    for batch in batches:
        for column in batch.columns:
            bits[_bit(column.to_numpy())] = True
    table = _table_rows(np.packbits(bits))
    if table:
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in table], pa.int32()), pa.array([c for _, c in table], pa.binary())], ["part", "counts"])


def marked(numbers: DataFrame) -> np.ndarray:
    """A table of 2^24 packed bits in which every number of a DataFrame of longs is marked (and others, by chance)."""
    return merged_table(numbers.mapInArrow(_marks, "part int, counts binary"), (1 << NODE_BITS) // 8, np.uint8, np.bitwise_or)


def _members(words: int, wanted):
    """(node, members) of the sets that some pair needs; the bits may let others pass, which the join then drops."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.unpackbits(wanted.value).astype(bool)
        for batch in batches:
            for _, sets, bounds, node in _chunks(batch, words):
                _, once = np.unique(node, return_index=True)
                once = once[(np.diff(bounds)[once] > 0) & needed[_bit(node[once])]]
                if len(once):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[once]), pa.array([sets[bounds[i] : bounds[i + 1]].tobytes() for i in once], pa.binary())], ["node", "members"]
                    )

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                a, b = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            chosen = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            if chosen.num_rows:
                yield chosen

    return run


def verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, by whole sets; ``docs`` has doc_id and text."""
    spark = docs.sparkSession
    wanted = marked(pairs.select("a", "b"))
    sets = docs.mapInArrow(tidy(_members(words, spark.sparkContext.broadcast(wanted))), "node long, members binary")
    # One set per content; both joins share this shuffle.
    sets = sets.dropDuplicates(["node"])
    both = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("left")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("members").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return saved(both.mapInArrow(tidy(_linked(percent)), "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Every round takes the smallest component among a node's neighbours and then the component of that component,
    until nothing changes; each round is written, so none repeats the ones before.
    """
    edges = saved(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges")
    state = saved(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "components")
    while True:
        near = edges.join(state, edges["b"] == state["node"]).groupBy("a").agg(F.min("component").alias("m"))
        nearest = state.join(near, state["node"] == near["a"], "left").select(
            "node", F.col("component").alias("was"), F.least("component", F.coalesce("m", "component")).alias("component")
        )
        above = nearest.select(F.col("node").alias("up"), F.col("component").alias("top"))
        jumped = nearest.join(above, nearest["component"] == above["up"], "left").select(
            "node", "was", F.least("component", F.coalesce("top", "component")).alias("component")
        )
        jumped = saved(jumped, "components")
        changed = jumped.where("component <> was").limit(1).count()
        state = jumped.select("node", "component")
        if not changed:
            return state


def _may_link(n, pos, m, other, percent: int):
    """Both entries are early enough in their prefixes for the pair to reach the overlap it needs."""
    need = F.ceil((n + m) * F.lit(percent) / F.lit(100 + percent))
    return F.least(n - pos, m - other) >= need


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, list_rows: int = LIST_ROWS
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable over links) of every row."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profile = saved(docs.mapInArrow(tidy(_profile(words)), "doc_id long, node long, n int, part int, counts binary"), "profile")
    rows = profile.where("part is null").select("doc_id", "node", "n")
    table = merged_table(profile.where("part is not null").select("part", "counts"), 1 << TABLE_BITS, np.int32, np.add)
    # Sizes up to the largest light size decide; larger sets cost the same under any boundary.
    sizes = {r["n"]: r["count"] for r in rows.where("n between 1 and 128").groupBy("n").count().collect()}
    boundary = best_boundary(sizes, list_length(table), percent)
    everywhere = spark.sparkContext.broadcast(table)
    postings = docs.mapInArrow(
        tidy(_postings(words, percent, boundary, list_rows, everywhere)), "sig long, node long, n int, pos int, part int, parts int"
    )
    in_part = Window.partitionBy("sig", "part").orderBy("pos", "node")
    lists = saved(
        postings.select(
            "*", *[F.first(c).over(in_part).alias(f"hub_{c}") for c in ("node", "n", "pos")]
        ).where("node <> hub_node or parts > 1"),
        "lists",
    )
    # The first entry of a whole list: for a list in parts it is the first of the parts' first entries.
    in_list = Window.partitionBy("sig").orderBy("hub_pos", "hub_node")
    firsts = saved(
        lists.where("parts > 1 and node = hub_node").select("sig", "hub_node", "hub_n", "hub_pos").distinct().select(
            "*", *[F.first(f"hub_{c}").over(in_list).alias(c) for c in ("node", "n", "pos")]
        ),
        "firsts",
    )
    near = _may_link(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos"), percent) & (F.col("node") != F.col("hub_node"))
    pair = (F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b"))
    with_hub = lists.where(near).select(*pair).union(firsts.where(near).select(*pair)).distinct()
    links = verified(docs, saved(with_hub, "pairs"), words, percent)
    joined = components(links)

    whole = firsts.groupBy(F.col("sig").alias("first_sig")).agg(F.min("node").alias("first_node"))
    named = (
        lists.select("sig", "node", "n", "pos", "hub_node").distinct()
        .join(whole, F.col("sig") == F.col("first_sig"), "left")
        .select("sig", "node", "n", "pos", F.coalesce("first_node", "hub_node").alias("hub_node"))
        .join(joined.select("node", F.col("component").alias("c")), "node", "left")
        .join(joined.select(F.col("node").alias("hub_node"), F.col("component").alias("hub_c")), "hub_node", "left")
        .select("sig", "node", "n", "pos", F.coalesce("c", "node").alias("c"), F.coalesce("hub_c", "hub_node").alias("hub_c"))
    )
    named = saved(named, "named")
    apart = named.where("c <> hub_c").select(*[F.col(c).alias(f"x_{c}") for c in named.columns])
    rest = apart.join(
        named,
        (F.col("x_sig") == F.col("sig")) & (F.col("x_c") != F.col("c"))
        & ((F.col("c") == F.col("hub_c")) | (F.col("x_node") < F.col("node")))
        & _may_link(F.col("x_n"), F.col("x_pos"), F.col("n"), F.col("pos"), percent),
    ).select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()
    rest = saved(rest, "pairs")
    if rest.limit(1).count():
        joined = components(links.union(verified(docs, rest, words, percent)))

    placed = rows.join(joined, "node", "left").withColumn(
        "component", F.when(F.col("n") > 0, F.coalesce("component", "node"))
    )
    placed = saved(placed.select("doc_id", "n", "component"), "placed")
    smallest = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    named = with_lookup(placed, smallest.where("members > 1"), "component", "members", placed.count())
    return named.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of df without near copies: of each component one row stays, one of those with the smallest id.

    Every row is decided by itself, whatever its id: rows with equal ids and different texts are different documents. Rows without
    shingles all stay. Rows without an id stay where their component has no row with one. A row's key is a 64-bit hash of id and text.
    """
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(text_col, F.lit("")))
    keyed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), key.alias("key"), F.col(text_col).alias("text"))
    found = jaccard_components(keyed, "key", "text", **options).where("n_shingles > 0")
    found = found.groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count("*").alias("rows"))
    ids = df.select(key.alias("doc_id"), F.col(id_col).cast("long").alias("id")).distinct()
    found = saved(found.join(ids, "doc_id"), "kept")
    first = F.min(F.struct(F.col("id").isNull(), "id", "doc_id")).alias("first")
    kept = found.groupBy("component").agg(first).select(F.col("first.doc_id").alias("kept"))
    # Rows to decide on: those of components with several rows. The others, most of them, pass by a
    # look at a bit table of fixed size; only rows with a mark are shuffled to be compared exactly.
    apart = found.where("component <> doc_id")
    several = apart.select("doc_id").union(apart.select("component").distinct()).union(found.where("rows > 1").select("doc_id"))
    bits = df.sparkSession.sparkContext.broadcast(marked(several))

    @F.arrow_udf("boolean")
    def has_mark(keys: pa.Array) -> pa.Array:
        at = _bit(keys.to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.array((bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

    flagged = keyed.select("row", "key", has_mark("key").alias("mark"))
    clear = flagged.where("not mark").select("row.*")
    doubtful = flagged.where("mark")
    known = found.select(F.col("doc_id").alias("known"))
    silent = doubtful.join(known, F.col("key") == F.col("known"), "left_anti").select("row.*")
    order = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    one = doubtful.join(kept, F.col("key") == F.col("kept"), "left_semi").withColumn("rank", F.row_number().over(order))
    return clear.unionAll(silent).unionAll(one.where("rank = 1").select("row.*"))
