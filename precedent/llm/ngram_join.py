"""Documents whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

Documents of the same set are one *node*. The shingles of a node are ordered by hash. Of two
linked nodes, each lacks at most n - ceil(0.75 n) of its shingles in the other, so the first
n - ceil(0.75 n) + m of them hold at least m common ones, for every m. The usual prefix filter
takes m = 1 for all. Here m adapts to the cost: a shingle that many nodes share makes many candidates and
says little, so a node with f such shingles in its prefix takes m = f + 1. Two nodes have the
smaller m of the two in common, which is more than the costly shingles of that one, so they meet
in another shingle, and the costly ones need not be joined at all. The prefix grows until this
holds, over the whole set if need be. Shingles that are costly within one task are known
beforehand (*hot*); others show in the first join (more than ``MOST_SHARED`` nodes) and send their
nodes, and no others, to a second one, with prefixes that are long enough if costly shingles are as
frequent in the rest of the set as in the part seen. A pair that no join has brought together then
has an *unsettled* node, whose m does not exceed its costly shingles.

Unsettled nodes are made up of costly shingles, as thousands of near copies of one text are. They
are first compared with pivots of their shingles. Then all pairs of them that share a shingle in prefixes
ordered by frequency among them are compared, unless they are in one component by now.
Candidates are checked with their exact sets; a pair that is already in one component needs no
check, as only components are asked for.

Edge cases: texts that are null or without words have no shingles and no links; rows of one
doc_id are rows of their own and keep their number; a null doc_id is linked as others are, but never names a
component unless all of its rows are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from precedent.llm.common import Tables, slices, trimmed
from precedent.llm.components import connected_components
from precedent.session import ship_package

WORDS = 5
#: Similarity in percent.
PERCENT = 75
#: A shingle in the prefixes of more nodes than this is costly.
MOST_SHARED = 24
#: Shingles past the plain prefix that are kept with a node, so that prefixes can grow.
SPARE = 32
#: A shingle is known to be costly before the first round if this share of a task's nodes, and
#: this many, have it. At most 1/share times the mean prefix length of shingles can be.
HOT_SHARE, HOT_LEAST = 0.01, 24
#: Texts are cut into words in slices of this many bytes, which take some 15 times as much for a moment.
SLICE_BYTES = 2_000_000
#: Words whose hashes a task remembers, the first that it meets, of some 200 bytes each. Hashing a word again costs little more than finding it.
KNOWN_WORDS = 10_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted 64-bit hashes of the distinct shingles of each text."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[str, int] = {}

    def _hashes(self, pieces: list[str]) -> np.ndarray:
        import xxhash

        found = list(map(self.known.get, pieces))
        at = [i for i, h in enumerate(found) if h is None]
        new = [pieces[i] for i in at]
        hashes = list(map(xxhash.xxh3_64_intdigest, new))
        for i, h in zip(at, hashes):
            found[i] = h
        room = max(0, KNOWN_WORDS - len(self.known))
        self.known.update(zip(new[:room], hashes))
        return np.array(found, np.uint64)

    def sequences(self, texts: pa.Array) -> list[np.ndarray]:
        """Hashes of the shingles of each text in order, repeats included."""
        texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
        lists = pc.ascii_split_whitespace(texts)
        encoded = lists.flatten().dictionary_encode()
        pieces = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        word = self._hashes(pieces)[encoded.indices.to_numpy()] if pieces else np.zeros(0, np.uint64)
        empty = np.array([not p for p in pieces], bool)
        empty = empty[encoded.indices.to_numpy()] if pieces else np.zeros(0, bool)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        # Splitting leaves empty words at the ends of a text.
        before = np.concatenate([[0], np.cumsum(~empty)])
        word, bounds = word[~empty], before[bounds]
        shingle = np.zeros(max(0, len(word) - self.words + 1), np.uint64)
        for k in range(self.words):
            shingle = _mixed(shingle * _M1 + word[k : len(word) - self.words + 1 + k]) if len(shingle) else shingle
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= self.words:
                out.append(shingle[a : b - self.words + 1])
            elif b > a:
                whole = np.uint64([b - a])
                for h in word[a:b]:
                    whole = _mixed(whole * _M1 + h)
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
        return out

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        return [_distinct(h) for h in self.sequences(texts)]


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; for some hundred of them a sort is faster than ``np.unique``."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shortest(n: int) -> int:
    """Length of the plain prefix of n shingles."""
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def node_of(shingles: np.ndarray) -> int:
    """64-bit name of a set."""
    import xxhash

    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def shingle_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n, head): head holds the first shingles by hash."""
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        seen: set[int] = set()  # a task passes the head of each node on once
        for batch in slices(trimmed(batches), "text", SLICE_BYTES):
            sets = shingler.sets(batch.column("text"))
            sizes = [len(s) for s in sets]
            nodes = [node_of(s) if len(s) else None for s in sets]
            new = [x is not None and x not in seen and not seen.add(x) for x in nodes]
            heads = _lists([s[: shortest(len(s)) + SPARE] if x else s[:0] for s, x in zip(sets, new)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), heads],
                names=["doc_id", "node", "n", "head"],
            )

    schema = "doc_id long, node long, n long, head array<long>"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, schema)


def hot_shingles(nodes: DataFrame) -> np.ndarray:
    """Shingles known to be costly from counts inside tasks; a bounded number (see HOT_SHARE)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            if not batch.num_rows:
                continue
            tokens, counts = np.unique(_prefixes(batch)[0], return_counts=True)
            often = counts >= max(HOT_LEAST, HOT_SHARE * batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(tokens[often])], names=["token"])

    rows = nodes.select("n", "head").mapInArrow(run, "token long").distinct().collect()
    return np.sort(np.array([r["token"] for r in rows], np.int64))


def _prefixes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the plain prefixes of a batch, and the number of each row's."""
    flat, starts = _flat(batch.column("head"))
    sizes = np.array([shortest(n) for n in batch.column("n").to_pylist()], np.int64)
    within = np.arange(len(flat)) - np.repeat(starts[:-1], np.diff(starts))
    return flat[within < np.repeat(sizes, np.diff(starts))], sizes


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    starts = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), starts - starts[0]


def grown_prefix(head: np.ndarray, n: int, costly: np.ndarray) -> tuple[int, int]:
    """(length, m): the shortest prefix of ``head`` whose m exceeds its costly shingles.

    ``costly`` flags the shingles of ``head``. If the head ends first, all of it is taken.
    """
    base = shortest(n)
    seen = np.concatenate([[0], np.cumsum(costly)])
    lengths = np.arange(base, len(head) + 1)
    enough = np.nonzero(lengths - base + 1 > seen[lengths])[0]
    length = int(lengths[enough[0]]) if len(enough) else len(head)
    return length, length - base + 1


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in the sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _flagged(batch: pa.RecordBatch, hot: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(node, n, head, flags of the hot shingles) of each row."""
    flat, starts = _flat(batch.column("head"))
    is_hot = _member(flat, hot)
    nodes, sizes = batch.column("node").to_pylist(), batch.column("n").to_pylist()
    for node, n, a, b in zip(nodes, sizes, starts[:-1].tolist(), starts[1:].tolist()):
        yield node, n, flat[a:b], is_hot[a:b]


#: slack: m less the hot shingles of the prefix; rest: shingles beyond the prefix; hot: hot ones in it.
#: A second prefix allows for this many times the costly shingles that are expected, and a few.
ALLOWANCE, FEW = 1.25, 2
TOKENS = "token long, node long"
NODES = "node long, n long, slack int, rest long, hot int"


def _emit(rows: list[tuple[int, np.ndarray]], *names: str) -> pa.RecordBatch:
    sizes = [len(values) for _, values in rows]
    owner = np.repeat(np.array([key for key, _ in rows], np.int64), sizes)
    values = np.concatenate([np.zeros(0, np.int64), *(v for _, v in rows)])
    return pa.RecordBatch.from_arrays([pa.array(values), pa.array(owner)], names=list(names))


def _prefix(batch: pa.RecordBatch, at: int, n: int, head: np.ndarray, is_hot: np.ndarray | None) -> tuple[int, int]:
    """(length, m) of one node, from what is known of its costly shingles.

    ``seen`` (costly shingles, out of how many) is there in the second join, which needs no ``is_hot``.
    """
    if "seen" not in batch.schema.names:
        return grown_prefix(head, n, is_hot)
    base = shortest(n)
    share = batch.column("seen")[at].as_py() / max(1, batch.column("out_of")[at].as_py())
    # The least length for which length - base + 1 exceeds ALLOWANCE * share * length + FEW.
    left = 1 - ALLOWANCE * share
    length = len(head) if left <= 0 else min(len(head), max(base, int((FEW + base - 1) / left) + 1))
    return length, length - base + 1


def _known_columns(nodes: DataFrame) -> list[str]:
    return ["node", "n", "head", *(c for c in ("seen", "out_of") if c in nodes.columns)]


def prefix_tokens(nodes: DataFrame, hot: np.ndarray, whole: bool) -> DataFrame:
    """(token, node) of the prefixes, hot tokens left out.

    Unless ``whole``, head is but the beginning of a set, and nodes for which it is too short are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            rows = []
            for at, (node, n, head, is_hot) in enumerate(_flagged(batch, hot)):
                length, m = _prefix(batch, at, n, head, is_hot)
                if whole or m > is_hot[:length].sum():
                    rows.append((node, head[:length][~is_hot[:length]]))
            yield _emit(rows, "token", "node")

    return nodes.select(*_known_columns(nodes)).mapInArrow(run, TOKENS)


def prefix_facts(nodes: DataFrame, hot: np.ndarray) -> DataFrame:
    """(node, n, slack, rest, hot) of the same prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            rows = []
            for at, (node, n, head, is_hot) in enumerate(_flagged(batch, hot)):
                length, m = _prefix(batch, at, n, head, is_hot)
                hots = int(is_hot[:length].sum())
                rows.append((node, n, m - hots, n - length, hots))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["node", "n", "slack", "rest", "hot"]
            )

    return nodes.select(*_known_columns(nodes)).mapInArrow(run, NODES)


def hot_tokens(nodes: DataFrame, hot: np.ndarray) -> DataFrame:
    """(token, node) of the hot tokens in plain prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            rows = []
            for node, n, head, is_hot in _flagged(batch, hot):
                base = shortest(n)
                rows.append((node, head[:base][is_hot[:base]]))
            yield _emit(rows, "token", "node")

    return nodes.select("node", "n", "head").mapInArrow(run, TOKENS)


MET = "a long, b long, token long"


def meetings(tokens: DataFrame) -> DataFrame:
    """(a, b, token) of nodes that share a token, b null where the token turned out costly.

    The rows of a token stand together in a partition; a run is held until it is known to be costly, ``MOST_SHARED`` rows at
    most, and then passed on row by row.
    """
    most = MOST_SHARED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_t, held_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        costly = None  # the token of the open run if it is costly already
        for batch in trimmed(batches):
            t = np.concatenate([held_t, batch.column("token").to_numpy()])
            n = np.concatenate([held_n, batch.column("node").to_numpy()])
            if not len(t):
                continue
            cut = int(np.searchsorted(t, t[-1], "left"))  # the last run may go on
            yield from closed(t[:cut], n[:cut], costly)
            open_t, open_n = t[cut:], n[cut:]
            if costly is not None and open_t[0] != costly:
                costly = None
            if costly is not None or len(open_t) > most:
                costly = int(open_t[0])
                yield made(open_n, None, open_t)
                open_t, open_n = open_t[:0], open_n[:0]
            held_t, held_n = open_t, open_n
        yield from closed(held_t, held_n, costly)

    def made(a: np.ndarray, b: np.ndarray | None, t: np.ndarray) -> pa.RecordBatch:
        other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
        return pa.RecordBatch.from_arrays([pa.array(a), other, pa.array(t)], names=["a", "b", "token"])

    def closed(t: np.ndarray, n: np.ndarray, costly: int | None) -> Iterator[pa.RecordBatch]:
        """Meetings of whole runs."""
        if not len(t):
            return
        starts = np.concatenate([[0], np.nonzero(t[1:] != t[:-1])[0] + 1])
        sizes = np.diff(np.append(starts, len(t)))
        big = sizes > most
        if costly is not None and t[0] == costly:
            big[0] = True
        rows = np.repeat(big, sizes)
        if rows.any():
            yield made(n[rows], None, t[rows])
        for size in np.unique(sizes[~big & (sizes > 1)]).tolist():
            block = n[starts[~big & (sizes == size)][:, None] + np.arange(size)]
            at = t[starts[~big & (sizes == size)]]
            i, j = np.triu_indices(size, 1)
            for k in range(0, len(block), 20_000):
                a, b = block[k : k + 20_000, i].ravel(), block[k : k + 20_000, j].ravel()
                yield made(np.minimum(a, b), np.maximum(a, b), np.repeat(at[k : k + 20_000], len(i)))

    return tokens.repartition("token").sortWithinPartitions("token").mapInArrow(run, MET)



def possible_pairs(met: DataFrame, facts: DataFrame) -> DataFrame:
    """(a, b, common) of met pairs whose overlap can still suffice.

    What two sets share beyond the common tokens seen is costly in both, or lies beyond the prefix of the
    one whose prefix ends first.
    """
    costly = met.where("b is null").groupBy("a").agg(F.count("*").alias("found"))
    facts = facts.join(costly.withColumnRenamed("a", "node"), "node", "left").select(
        "node", "n", "rest", (F.col("hot") + F.coalesce("found", F.lit(0))).alias("costly")
    )
    pairs = met.where("b is not null").groupBy("a", "b").agg(F.count("*").alias("common"))
    for side in ("a", "b"):
        own = facts.select(*(F.col(c).alias(f"{c}_{side}") for c in facts.columns))
        pairs = pairs.join(own, F.col(side) == F.col(f"node_{side}"))
    most = F.col("common") + F.least("costly_a", "costly_b") + F.greatest("rest_a", "rest_b")
    total = F.col("n_a") + F.col("n_b")
    return pairs.where(
        (most * (100 + PERCENT) >= PERCENT * total)
        & (F.least("n_a", "n_b") * 100 >= PERCENT * F.greatest("n_a", "n_b"))
    ).select("a", "b", "common")


def unsettled(met: DataFrame, facts: DataFrame) -> DataFrame:
    """(node, partial): nodes of ``facts`` whose m does not exceed their costly shingles.

    A settled node has fewer costly shingles in its prefix than it must share there with any linked
    one. Against an unsettled node that was joined with its whole set it has met it in another shingle, so such nodes can
    have missed each other only; ``partial`` marks the others.
    """
    found = met.where("b is null").groupBy("a").agg(F.count("*").alias("found"))
    return facts.join(found.withColumnRenamed("a", "node"), "node", "left").where(
        F.coalesce("found", F.lit(0)) >= F.col("slack")
    ).select("node", (F.col("rest") > 0).alias("partial"))


def whole_sets(
    wanted: DataFrame, nodes: DataFrame, docs: DataFrame, tables: Tables, name: str, hot: np.ndarray | None = None
) -> DataFrame:
    """(node, n, head) with the whole sets of the ``wanted`` nodes, stored under ``name``.

    With ``hot``, the sets are cut to the prefix that is taken of them, and what is known of a node stays with it.

    The sets are made again from one text of each node: keeping them all would take more room
    than the texts. A text that is there more than once under its id is told apart by a count
    over the stored names, so that the sets themselves are not shuffled.
    """
    spark = docs.sparkSession
    known = [c for c in _known_columns(wanted) if c not in ("n", "head")] if hot is not None else ["node"]
    own = nodes.select("node", F.col("doc_id").alias("want")).join(wanted.select(*known).distinct(), "node")
    texts = docs.selectExpr("cast(doc_id as long) as doc_id", "text").join(
        own, F.col("doc_id").eqNullSafe(F.col("want"))
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        made: set[int] = set()
        for batch in slices(trimmed(batches), "text", SLICE_BYTES):
            node = batch.column("node").to_pylist()
            # Another text of the same id has another name.
            rows = [
                (at, s)
                for at, (k, s) in enumerate(zip(node, shingler.sets(batch.column("text"))))
                if k not in made and len(s) and node_of(s) == k and not made.add(k)
            ]
            heads = [s for _, s in rows]
            if hot is not None:
                flags = [None if "seen" in known else _member(s.view(np.int64), hot) for s in heads]
                heads = [s[: _prefix(batch, at, len(s), s, f)[0]] for (at, s), f in zip(rows, flags)]
            facts = batch.select(known).take(pa.array([at for at, _ in rows], pa.int64()))
            sizes = pa.array([len(s) for _, s in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([*facts.columns, sizes, _lists(heads)], names=[*known, "n", "head"])

    ship_package(spark)
    schema = ", ".join(f"{c} long" for c in [*known, "n"]) + ", head array<long>"
    sets = texts.select(*known, "text").mapInArrow(make, schema)
    found = tables.store(sets, name)
    if found.groupBy("node").count().where("count > 1").isEmpty():
        return found
    return tables.store(found.dropDuplicates(["node"]), name)


def exact_links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, tables: Tables) -> DataFrame:
    """The (a, b) of ``pairs`` that are linked, by their exact sets. Stored."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    sets = whole_sets(wanted, nodes, docs, tables, "checked").withColumnRenamed("head", "set")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= PERCENT * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # The pairs travel with one set and meet the other.
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    links = tables.store(joined.mapInArrow(check, "a long, b long"), "links")
    tables.drop("checked")
    return links


def _labelled(rows: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the label of ``key``; a node without links is its own label."""
    own = labels.select(F.col("node").alias(key), F.col("label").alias(name))
    return rows.join(own, key, "left").withColumn(name, F.coalesce(name, key))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    both = _labelled(_labelled(pairs, labels, "a", "_la"), labels, "b", "_lb")
    return both.where("_la <> _lb").select("a", "b")


def _size_class(n: str) -> Column:
    """Sizes of linked nodes differ by less than one class and a bit: the same class or the next."""
    return F.floor(F.log(F.col(n)) / float(np.log(100 / PERCENT)) + 1e-9).cast("int")


def pivot_pairs(shared: DataFrame, turn: int) -> DataFrame:
    """(a, b): unsettled nodes with pivots, one at random for a token and size class.

    A quarter of the tokens, another one each ``turn``, is enough to tie most near copies together.
    """
    rows = shared.where("open").where(F.pmod("token", F.lit(4)) == turn)
    pivots = rows.groupBy("token", "class").agg(F.min_by("node", F.xxhash64("node", "token")).alias("p"))
    rows = rows.join(pivots, ["token", "class"]).where("node <> p")
    return rows.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()


def rare_first_pairs(sets: DataFrame, labels: DataFrame, tables: Tables) -> DataFrame:
    """(a, b): nodes of ``sets`` in different components with a token in common in their plain prefixes.

    ``sets`` are the whole sets of the unsettled nodes, few enough to count their tokens; in this order
    the prefixes begin with the tokens that the fewest of them have. Beyond the first token that two sets
    share, the overlap is what remains of the shorter rest, so a pair is made only where that still suffices.
    """
    tokens = _labelled(sets, labels, "node", "label").select("node", "n", "label", F.explode("head").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df"))
    order = Window.partitionBy("node").orderBy("df", "token")
    ranked = tokens.join(counts, "token").withColumn("at", F.row_number().over(order))
    rows = tables.store(ranked.where(F.col("at") <= F.col("n") - _beyond("n")).where("df > 1"), "rare")
    one, two = (rows.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "label", "at"))) for x in "ab")
    pairs = one.join(two, "token").where(
        f"label_a <> label_b and node_a < node_b and least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {PERCENT}"
        f" and (1 + least(n_a - at_a, n_b - at_b)) * {100 + PERCENT} >= {PERCENT} * (n_a + n_b)"
    )
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def partial_pairs(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): a partial node and any of another component, similar in size, whose overlap can
    suffice though they have costly tokens only in common before one of the plain prefixes ends."""
    rows = _labelled(shared, labels, "node", "label")
    one = rows.where("partial").select(
        "token", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("_la"),
        F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"),
    )
    two = rows.select("token", "class", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("_lb"))
    pairs = one.join(two, ["token", "class"]).where(
        f"_la <> _lb and least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {PERCENT}"
    )
    pairs = pairs.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("common"))
    most = F.col("common") + F.greatest(_beyond("n_a"), _beyond("n_b"))
    pairs = pairs.where(most * (100 + PERCENT) >= PERCENT * (F.col("n_a") + F.col("n_b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _beyond(n: str) -> Column:
    """Shingles of a set of n that lie beyond its plain prefix."""
    return F.ceil(F.col(n) * PERCENT / 100) - 1


def link_components(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n, label) of every row of ``docs`` (doc_id, text).

    ``node`` names the set (null: empty) and ``label`` its component.
    """
    tables = Tables(docs.sparkSession, "ngram-join")
    heads = tables.store(shingle_rows(docs), "heads")
    rows = tables.store(heads.select("doc_id", "node", "n"), "rows")
    nodes = tables.store(
        heads.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n").alias("n"),
            F.first(F.when(F.size("head") > 0, F.col("head")), ignorenulls=True).alias("head"),
        ),
        "nodes",
    )
    tables.drop("heads")
    hot = hot_shingles(nodes)
    facts, tokens = prefix_facts(nodes, hot), prefix_tokens(nodes, hot, whole=False)
    short = facts.where("slack <= 0").select("node")
    if len(hot):
        sets = whole_sets(short, nodes, docs, tables, "short", hot)
        facts = facts.where("slack > 0").union(prefix_facts(sets, hot))
        tokens = tokens.union(prefix_tokens(sets, hot, whole=True))
    facts = tables.store(facts, "facts")
    met = tables.store(meetings(tokens), "met")
    if len(hot):
        tables.drop("short")
    # Hot tokens of all nodes; from here on the heads are not needed.
    hot_rows = tables.store(hot_tokens(nodes, hot), "hot")
    nodes = tables.store(nodes.select("node", "doc_id", "n"), "names")
    tables.drop("nodes")
    pairs = tables.store(possible_pairs(met, facts), "first")
    costly = tables.store(met.where("b is null").select("token", F.col("a").alias("node")), "costly")
    tables.drop("met")
    seen = costly.groupBy("node").agg(F.count("*").alias("own"))
    seen = seen.join(facts, "node").select(
        "node", (F.col("own") + F.col("hot")).alias("seen"), (F.col("n") - F.col("rest")).alias("out_of")
    )
    seen = tables.store(seen, "seen")
    again = whole_sets(seen, nodes, docs, tables, "again", hot)
    grown = tables.store(prefix_facts(again, hot), "grown")
    met_again = tables.store(meetings(prefix_tokens(again, hot, whole=True)), "met")
    tables.drop("again")
    pairs = tables.store(
        pairs.union(possible_pairs(met_again, grown)).groupBy("a", "b").agg(F.max("common").alias("common")), "pairs"
    )
    open_nodes = facts.where("slack <= 0").select("node", F.lit(False).alias("partial"))
    open_nodes = open_nodes.union(unsettled(met_again, grown)).groupBy("node").agg(F.max("partial").alias("partial"))
    open_nodes = tables.store(open_nodes, "open")
    tables.drop("met", "first")

    has_partial = not open_nodes.where("partial").isEmpty()

    # Costly tokens that an unsettled node has, with all nodes that have them.
    marked = costly.union(hot_rows).join(open_nodes.withColumn("open", F.lit(True)), "node", "left")
    wanted = marked.where("open").select("token").distinct()
    shared = tables.store(
        marked.join(wanted, "token", "left_semi")
        .join(nodes.select("node", "n"), "node")
        .select(
            "token", "node", "n", _size_class("n").alias("class"),
            *(F.coalesce(c, F.lit(False)).alias(c) for c in ("open", "partial")),
        ),
        "shared",
    )
    tables.drop("costly", "hot")

    # First each node with the one that it shares most with, and with pivots; then all that is still apart.
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("common", "a")).alias("a")).select("a", "b")
    done = tables.store(best.union(pivot_pairs(shared, 0)).distinct(), "done")
    links = exact_links(done, nodes, docs, tables)
    labels = connected_components(links)
    steps = (
        lambda: pairs.select("a", "b").union(pivot_pairs(shared, 1)).union(pivot_pairs(shared, 2)),
        lambda: rare_first_pairs(whole_sets(open_nodes, nodes, docs, tables, "unsettled"), labels, tables).union(
            partial_pairs(shared, labels) if has_partial else pairs.select("a", "b").limit(0)
        ),
    )
    for step in steps:
        more = tables.store(_apart(step().distinct(), labels).join(done, ["a", "b"], "left_anti"), "more")
        if not more.isEmpty():
            found = exact_links(more, nodes, docs, tables)
            if not found.isEmpty():
                links = links.union(found)
                labels = connected_components(links)
            done = done.union(more)
    tables.drop("unsettled", "rare", "shared")
    return _labelled(rows, labels, "node", "label")


def similar_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    rows = link_components(docs)
    least = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


@F.arrow_udf(LongType())
def node_column(text: pa.Array) -> pa.Array:
    """The node of each text, null if it has no words. Batches are cut, as a slice takes many times its bytes for a moment."""
    shingler, nodes = Shingler(), []
    for part in slices([pa.RecordBatch.from_arrays([text], names=["text"])], "text", SLICE_BYTES):
        nodes += [node_of(s) if len(s) else None for s in shingler.sets(part.column("text"))]
    return pa.array(nodes, pa.int64())
