"""TF-IDF weights and nearest tickets by shared terms.

weight(term, text) = tf * (ln((n + 1) / (df + 1)) + 1), scaled to unit length, so
a score is the cosine of two texts. A term that no ticket has (df = 0) still
counts towards the length of a query.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precedent.llm.common import trimmed
from precedent.operators.blocks import cogroup_hits, scan_hits
from precedent.operators.rank import top_k_per_query
from precedent.operators.skew import BROADCAST_BYTES, salted_join, text_bytes
from precedent.schemas import RANK_DIGITS
from precedent.session import Tables, materialize, ship_package

# Fixed value: a token is a run of these characters in lowercased text.
TOKEN_PATTERN = "[a-z0-9à-ÿ]+"

BROADCAST_QUERIES = 4096
BLOCK_POSTINGS = 2_000_000
BLOCK_QUERIES = 4096
# Blocks of queries grow up to this many times where there are more blocks of tickets than cores.
BLOCK_GROWTH = 4
# Entries of the queries that are compared with all tickets before the next ones are.
WAVE_POSTINGS = 500_000
MAX_BROADCAST_BLOCKS = 1_000_000
# Heaviest tickets kept per term to find a floor for every query.
HEAD_TICKETS = 32
SLACK = 1e-7
# Text that a task cuts into tokens and counts: its table of counts is some 15 times as large.
TASK_TEXT_BYTES = 8 << 20
# Terms whose document frequency is sent to every task, by measured size, and the longest of them.
FREQUENT_BYTES = 4 << 20
LONG_TERM = 256
# Entries of texts that a task handles at a time.
PIECE_TERMS = 250_000
# Cells of a score matrix, which a core's cache should hold, and products added up at a time inside a task.
TILE_CELLS = 250_000
STEP_PRODUCTS = 250_000


def text_counts(texts: DataFrame, key: str, text: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``(key, terms, tfs)``: one row per text that has a term, terms in their order.

    Texts are placed by ``key`` before they are cut into tokens: the text is a
    fraction of the size of its exploded tokens, and the count then needs no
    shuffle of its own. The number of places follows the bytes of text, since adaptive
    execution sizes partitions by what is shuffled, not by the tables of counts made of it.
    """
    spark = texts.sparkSession
    ship_package(spark)
    tasks = max(spark.sparkContext.defaultParallelism, -(-text_bytes(texts, text) // TASK_TEXT_BYTES))
    tokens = F.transform("terms", lambda t: F.regexp_extract_all(F.lower(t), F.lit(pattern), F.lit(0)))
    rows = (
        texts.select(key, F.col(text).alias("terms"))
        .repartition(tasks, key)
        .groupBy(key)
        .agg(F.collect_list("terms").alias("terms"))
        .select(key, F.flatten(tokens).alias("terms"))
    )

    def count(batches):
        for piece in _pieces(batches):
            row, token, _ = _flatten(piece)
            # Terms are numbered in their order, so that the numbers sort as the terms do.
            found = token.dictionary_encode()
            order = pc.sort_indices(found.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            number = place[found.indices.to_numpy()] if len(token) else np.empty(0, np.int64)
            pairs, tf = np.unique(row.astype(np.int64) * max(1, len(order)) + number, return_counts=True)
            row, number = np.divmod(pairs, max(1, len(order)))
            term = found.dictionary.take(pa.array(order[number]))
            yield from _listed(piece, row, terms=term, tfs=pa.array(tf, pa.int64()))

    kinds = {"terms": T.ArrayType(T.StringType()), "tfs": T.ArrayType(T.LongType())}
    return rows.mapInArrow(count, _with_lists(rows, key, kinds)).where(F.size("terms") > 0)


def term_counts(texts: DataFrame, key: str, text: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``(key, term, tf)``."""
    counts = text_counts(texts, key, text, pattern).select(key, F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    return counts.select(key, F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))


def vocabulary(counts: DataFrame, n_texts: int) -> DataFrame:
    """``(term, df, idf)`` of a corpus of ``n_texts`` texts, from its :func:`text_counts`."""
    terms = counts.select(F.explode("terms").alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn("idf", _idf("df", n_texts))


def _idf(df: str, n_texts: int):
    return F.log(F.lit(n_texts + 1.0) / (F.col(df) + 1.0)) + 1.0


def _frequent(vocab: DataFrame, most: int) -> tuple[pa.Table, DataFrame | None]:
    """The most frequent terms ``(term, df)``, up to ``most`` bytes, and the rest of the vocabulary or ``None`` where nothing is left."""
    long = F.octet_length("term") > LONG_TERM
    size = F.sum(F.octet_length("term") + 16).alias("size")
    # Few rows: a term in many texts takes as many places, so there are not many different numbers of texts.
    sizes = vocab.groupBy("df", long.alias("long")).agg(size).toArrow().to_pandas().sort_values("df", ascending=False)
    taken = ~sizes["long"] & (sizes["size"].where(~sizes["long"], 0).cumsum() <= most)
    left = sizes["df"][~taken & ~sizes["long"]].max() if (~taken & ~sizes["long"]).any() else -1
    known = (F.col("df") > int(left)) & ~long
    frequent = vocab.where(known).select("term", "df").toArrow()
    return frequent, None if taken.all() else vocab.where(~known)


def _found(frequent: pa.Table, term: pa.Array) -> np.ndarray:
    """Row of each term among the frequent ones, -1 where it is not one of them."""
    value_set = frequent["term"].combine_chunks().cast(term.type)
    return pc.fill_null(pc.index_in(term, value_set=value_set), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _other_dfs(counts: DataFrame, frequent, rest: DataFrame, key: str) -> DataFrame:
    """``(key, others)``: place and document frequency of those terms of a text that are in ``rest``.

    Of the entries only those of terms that are not frequent are moved.
    """

    def places(batches):
        for piece in _pieces(batches):
            row, term, _ = _flatten(piece)
            at = np.flatnonzero(_found(frequent.value, term) < 0)
            begin = np.searchsorted(row, row[at])
            columns = [piece[key].combine_chunks().take(pa.array(row[at])), pa.array(at - begin, pa.int32()), term.take(pa.array(at))]
            yield from pa.table(columns, names=[key, "place", "term"]).to_batches()

    schema = T.StructType([counts.schema[key], T.StructField("place", T.IntegerType()), T.StructField("term", T.StringType())])
    absent = counts.mapInArrow(places, schema)
    n = rest.select("term", F.col("df").alias("n"))
    met = salted_join(absent, rest.select("term", "df"), "term", key, "inner", n)
    return met.groupBy(key).agg(F.collect_list(F.struct("place", "df")).alias("others"))


def term_weights(counts: DataFrame, vocab: DataFrame, key: str, n_texts: int, least: int = 0) -> DataFrame:
    """One row per text: ``(key, terms, weights)`` of unit length, rarest term first.

    All terms of one text meet in one row, as they do in the text itself. The document frequencies of the most
    frequent terms, which make up most of a text, are broadcast (``FREQUENT_BYTES``) and those of the others joined.
    A term that ``vocab`` does not have is in ``least`` texts.
    """
    spark = counts.sparkSession
    ship_package(spark)
    frequent, rest = _frequent(vocab, FREQUENT_BYTES)
    shared = spark.sparkContext.broadcast(frequent)
    joined = rest is not None
    if joined:
        others = Tables(spark, "others").store(_other_dfs(counts, shared, rest, key), "others", "zstd").withColumnRenamed(key, "_key")
        # Half the bytes of the lists as Spark would move them.
        counts = _packed(counts, key).join(others, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")

    def weigh(batches):
        for piece in _unpacked(batches) if joined else _pieces(batches):
            row, term, tf = _flatten(piece, "tfs")
            at = _found(shared.value, term)
            df = np.full(len(term), least, np.int64)
            df[at >= 0] = shared.value["df"].to_numpy()[at[at >= 0]]
            if "others" in piece.column_names:
                others = piece["others"].combine_chunks()
                known, of = others.flatten(), pc.list_parent_indices(others).to_numpy()
                begin = np.searchsorted(row, np.arange(piece.num_rows))
                df[begin[of] + known.field("place").to_numpy()] = known.field("df").to_numpy()
            weight = tf * (np.log((n_texts + 1.0) / (df + 1.0)) + 1.0)
            norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=piece.num_rows))
            # Terms of one frequency stay in their order.
            order = np.lexsort((df, row))
            yield from _listed(piece, row, terms=term.take(pa.array(order)), weights=pa.array((weight / norm[row])[order]))

    kinds = {"terms": T.ArrayType(T.StringType()), "weights": T.ArrayType(T.DoubleType())}
    return counts.mapInArrow(weigh, _with_lists(counts, key, kinds))


def tfidf(
    texts: DataFrame, key: str, text: str, pattern: str = TOKEN_PATTERN
) -> tuple[DataFrame, DataFrame, int]:
    """Weights, vocabulary and size of a corpus.

    Counts and vocabulary are read several times and therefore kept.
    """
    n_texts = texts.count()
    tables = Tables(texts.sparkSession, "tfidf")
    counts = tables.store(text_counts(texts, key, text, pattern), "counts", "zstd")
    vocab = tables.store(vocabulary(counts, n_texts), "vocabulary", "zstd")
    return corpus_weights(counts, vocab, key, n_texts), vocab, n_texts


def corpus_weights(counts: DataFrame, vocab: DataFrame, key: str, n_texts: int) -> DataFrame:
    """:func:`term_weights` of the texts that the vocabulary is of; what only one of them has need not be looked up."""
    return term_weights(counts, vocab.where("df > 1"), key, n_texts, least=1)


def query_weights(
    queries: DataFrame, text: str, vocab: DataFrame, n_texts: int, pattern: str = TOKEN_PATTERN
) -> DataFrame:
    """Weights of query texts under the vocabulary of a corpus.

    The vocabulary is first reduced to the terms asked for: without a shuffle when
    these are few enough to broadcast.
    """
    counts = materialize(text_counts(queries, "query_id", text, pattern))
    terms = counts.select(F.explode("terms").alias("term")).distinct()
    if text_bytes(terms, "term") <= BROADCAST_BYTES:
        terms = F.broadcast(terms)
    asked = materialize(vocab.join(terms, "term", "left_semi"))
    return term_weights(counts, asked, "query_id", n_texts)


# -- lists of terms -----------------------------------------------------------


def _pieces(batches, size=lambda batch: pc.list_value_length(batch.column("terms"))) -> Iterator[pa.Table]:
    """The rows with about ``PIECE_TERMS`` terms at a time; a longer text is a piece of its own."""
    for batch in trimmed(batches):
        ends = np.cumsum(pc.fill_null(size(batch), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            last = max(at + 1, int(np.searchsorted(ends, done + PIECE_TERMS, side="right")))
            yield pa.Table.from_batches([batch.slice(at, last - at)])
            at = last


def _packed(counts: DataFrame, key: str) -> DataFrame:
    """``(key, n, bytes, packed)``: the terms of a text, their lengths and their counts, compressed."""

    def pack(batches):
        for piece in _pieces(batches):
            row, term, tf = _flatten(piece, "tfs")
            term = term.cast(pa.large_binary())
            length = pc.binary_length(term).to_numpy(zero_copy_only=False).astype(np.int64)
            begin = np.searchsorted(row, np.arange(piece.num_rows + 1))
            at = np.concatenate([[0], np.cumsum(length)])[begin]
            begin_of_all = np.frombuffer(term.buffers()[1], np.int64, 1, 8 * term.offset)[0] if len(term) else 0
            text = memoryview(term.buffers()[2] or b"")[begin_of_all:]
            size, packed = [], []
            for i in range(piece.num_rows):
                of = slice(begin[i], begin[i + 1])
                whole = length[of].astype(np.int32).tobytes() + tf[of].astype(np.int64).tobytes() + bytes(text[at[i] : at[i + 1]])
                size.append(len(whole))
                packed.append(pa.compress(whole, "zstd", asbytes=True))
            columns = [piece.column(0), pa.array(np.diff(begin), pa.int32()), pa.array(size, pa.int64()), pa.array(packed, pa.binary())]
            yield from pa.table(columns, names=[piece.column_names[0], "n", "bytes", "packed"]).to_batches()

    added = [("n", T.IntegerType()), ("bytes", T.LongType()), ("packed", T.BinaryType())]
    return counts.mapInArrow(pack, T.StructType([counts.schema[key], *(T.StructField(*a) for a in added)]))


def _unpacked(batches) -> Iterator[pa.Table]:
    """What was packed as lists again, with the other columns."""
    for piece in _pieces(batches, lambda batch: batch.column("n")):
        n = piece["n"].to_numpy()
        length, tf, text = [], [], []
        for count, size, packed in zip(n, piece["bytes"].to_pylist(), piece["packed"].to_pylist()):
            whole = pa.decompress(packed, size, "zstd", asbytes=True)
            length.append(np.frombuffer(whole, np.int32, count))
            tf.append(np.frombuffer(whole, np.int64, count, 4 * count))
            text.append(whole[12 * count :])
        begin = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int32), *length]), dtype=np.int64)])
        buffers = [None, pa.py_buffer(begin.tobytes()), pa.py_buffer(b"".join(text))]
        term = pa.Array.from_buffers(pa.large_string(), len(begin) - 1, buffers).cast(pa.string())
        ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        lists = pa.ListArray.from_arrays(ends, term), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *tf])))
        yield piece.drop_columns(["n", "bytes", "packed"]).append_column("terms", lists[0]).append_column("tfs", lists[1])


def _listed(piece: pa.Table, row: np.ndarray, **values: pa.Array) -> list[pa.RecordBatch]:
    """The first column of the piece, and lists of the values, which come by ``row``."""
    ends = pa.array(np.searchsorted(row, np.arange(piece.num_rows + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, v) for v in values.values()]
    return pa.table([piece.column(0), *lists], names=[piece.column_names[0], *values]).to_batches()


def _with_lists(rows: DataFrame, key: str, kinds: dict) -> T.StructType:
    return T.StructType([rows.schema[key], *(T.StructField(name, kind) for name, kind in kinds.items())])


# -- scoring ----------------------------------------------------------------


def _flatten(table: pa.Table, values: str = "weights") -> tuple[np.ndarray, pa.Array, np.ndarray | None]:
    """Row and term of every entry, and its value where the table has them."""
    terms = table["terms"].combine_chunks()
    value = table[values].combine_chunks().flatten().to_numpy(zero_copy_only=False) if values in table.column_names else None
    return pc.list_parent_indices(terms).to_numpy(), terms.flatten(), value


class LexicalCandidates:
    """Entries of a query block that may reach the floors. Terms are looked up once per block, and only products of shared terms are made."""

    def __init__(self, queries: pa.Table):
        row, term, self.weight = _flatten(queries)
        self.terms = pc.unique(term)
        self.code = pc.index_in(term, value_set=self.terms).to_numpy(zero_copy_only=False).astype(np.int64)
        self.begin = np.searchsorted(row, np.arange(queries.num_rows + 1))

    def against(self, tickets: pa.Table):
        """Postings of the tickets by the queries' terms."""
        row, term, weight = _flatten(tickets)
        shared = pc.index_in(term, value_set=self.terms)
        kept = np.flatnonzero(shared.is_valid().to_numpy(zero_copy_only=False))
        code = shared.take(pa.array(kept)).to_numpy(zero_copy_only=False).astype(np.int64)
        by_term = np.argsort(code, kind="stable")
        ends = np.cumsum(np.bincount(code, minlength=len(self.terms)))
        return tickets.num_rows, np.concatenate([[0], ends]).astype(np.int64), row[kept[by_term]], weight[kept[by_term]]

    def matrices(self, tickets, rows: slice) -> Iterator[tuple[int, np.ndarray]]:
        """Score matrices of these queries against the tickets, in query tiles."""
        n, begin, ticket_row, ticket_weight = tickets
        tile = max(1, TILE_CELLS // max(1, n))
        for start in range(rows.start, rows.stop, tile):
            stop = min(rows.stop, start + tile)
            postings = slice(self.begin[start], self.begin[stop])
            code, weight = self.code[postings], self.weight[postings]
            row = np.repeat(np.arange(stop - start), np.diff(self.begin[start : stop + 1]))
            fan = begin[code + 1] - begin[code]
            matrix = np.zeros((stop - start) * n)
            # Entries are taken in steps of bounded total fan-out.
            reach = np.cumsum(fan)
            at = 0
            while at < len(code):
                done = reach[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(reach, done + STEP_PRODUCTS, side="right")))
                step = fan[at:end]
                entry = np.repeat(np.arange(at, end), step)
                posting = begin[code[entry]] + np.arange(len(entry)) - np.repeat(np.cumsum(step) - step, step)
                cell = row[entry] * np.int64(n) + ticket_row[posting]
                product = weight[entry] * ticket_weight[posting]
                matrix += np.bincount(cell, weights=product, minlength=len(matrix))
                at = end
            yield start - rows.start, matrix.reshape(stop - start, n)

    def find(self, tickets, rows: slice, floor: np.ndarray, k: int):
        """See ``blocks.BestHits``; only rounded scores above zero count."""
        half = 10.0**-RANK_DIGITS
        for offset, matrix in self.matrices(tickets, rows):
            bar = floor[offset : offset + len(matrix)]
            unset = np.flatnonzero(bar <= half) if matrix.shape[1] > k else []
            if len(unset):
                kth = np.partition(matrix[unset], -k, axis=1)[:, -k]
                bar[unset] = np.maximum(bar[unset], np.round(kth - half, RANK_DIGITS))
            at_q, at_ticket = np.nonzero(matrix >= (bar - half)[:, None])
            score = matrix[at_q, at_ticket]
            reached = np.flatnonzero(np.round(score, RANK_DIGITS) >= bar[at_q])
            yield at_q[reached] + offset, at_ticket[reached], score[reached]


def lexical_scorer(queries: pa.Table, tickets: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Score matrices of a query block against a ticket block, in query tiles."""
    block = LexicalCandidates(queries)
    yield from block.matrices(block.against(tickets), slice(0, queries.num_rows))


# -- joins ------------------------------------------------------------------


def _suffix_norms(weighted: DataFrame, key: str) -> DataFrame:
    """Per (text, term): the weight and the length of the text from that term on.

    Terms run from rare to frequent in every text, so two texts whose first shared
    term is t score at most the product of their lengths from t on.
    """
    ship_package(weighted.sparkSession)

    def norms(batches):
        for piece in _pieces(batches):
            row, term, weight = _flatten(piece)
            begin = np.searchsorted(row, np.arange(piece.num_rows + 1))
            rest = np.empty(len(weight))
            for first, end in zip(begin, begin[1:]):
                rest[first:end] = np.sqrt(np.cumsum(weight[first:end][::-1] ** 2)[::-1])
            columns = [piece.column(0).take(pa.array(row)), term, pa.array(weight), pa.array(rest)]
            yield from pa.table(columns, names=[key, "term", "weight", "rest"]).to_batches()

    added = [("term", T.StringType()), ("weight", T.DoubleType()), ("rest", T.DoubleType())]
    schema = T.StructType([weighted.schema[key], *(T.StructField(*a) for a in added)])
    return weighted.select(key, "terms", "weights").mapInArrow(norms, schema)


def _of_terms(table: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of a table by term that these terms ask for: without a shuffle where the terms are few enough to broadcast."""
    if text_bytes(terms, "term") > BROADCAST_BYTES:
        return table
    return table.join(F.broadcast(terms), "term", "left_semi")


def _asked_terms_only(forward: DataFrame, terms: DataFrame) -> DataFrame:
    """The tickets with those of their terms that are in ``terms``, as the others add to no score; all terms where these are
    too many to broadcast."""
    if text_bytes(terms, "term") > FREQUENT_BYTES:
        return forward
    ship_package(forward.sparkSession)
    shared = forward.sparkSession.sparkContext.broadcast(terms.select("term").toArrow())

    def keep(batches):
        for piece in _pieces(batches):
            row, term, weight = _flatten(piece)
            at = np.flatnonzero(_found(shared.value, term) >= 0)
            yield from _listed(piece, row[at], terms=term.take(pa.array(at)), weights=pa.array(weight[at]))

    return forward.mapInArrow(keep, forward.schema).where(F.size("terms") > 0)


def _in_block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def ticket_blocks(forward: DataFrame, block_postings: int = BLOCK_POSTINGS) -> int:
    """How many blocks of bounded size the tickets fill."""
    return max(1, -(-_postings(forward) // block_postings))


def _postings(weighted: DataFrame) -> int:
    return int(weighted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).head()[0])


def guides(forward: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Two tables that steer queries: heads of the terms, and terms of the blocks.

    Heads are the ``HEAD_TICKETS`` heaviest tickets of each term. Block terms hold
    the longest remaining length of any ticket per (term, block).
    """
    terms = _suffix_norms(forward, "ticket_id")
    heaviest = Window.partitionBy("term").orderBy(F.desc("weight"), "ticket_id")
    heads = (
        terms.withColumn("place", F.row_number().over(heaviest))
        .where(F.col("place") <= HEAD_TICKETS)
        .select("term", "ticket_id", "weight")
    )
    block_terms = terms.groupBy(
        "term", _in_block("ticket_id", blocks).alias("ticket_block")
    ).agg(F.max("rest").alias("longest"))
    return heads, block_terms


def _floors(query_terms: DataFrame, heads: DataFrame, k: int) -> DataFrame:
    """A score each query's k-th best ticket surely reaches, from the heads alone.

    At most ``HEAD_TICKETS`` rows per query term, however frequent the term is.
    """
    partial = (
        salted_join(
            query_terms.select("query_id", "term", F.col("weight").alias("query_weight")),
            heads,
            "term",
            "query_id",
            "inner",
        )
        .groupBy("query_id", "ticket_id")
        .agg(F.sum(F.col("query_weight") * F.col("weight")).alias("similarity_score"))
    )
    return (
        top_k_per_query(partial, k)
        .groupBy("query_id")
        .agg(F.when(F.count(F.lit(1)) >= k, F.min("similarity_score")).alias("floor"))
    )


def block_hits(
    forward: DataFrame,
    queries: DataFrame,
    k: int,
    blocks: int,
    heads: DataFrame,
    block_terms: DataFrame,
    block_queries: int = BLOCK_QUERIES,
    tables: Tables | None = None,
) -> DataFrame:
    """Best k tickets per query and ticket block, for a wave of queries.

    A query visits a block only over a term from which on the two can still reach
    the query's floor; terms too frequent to matter open no block. Visits meet
    tickets in an equi-join on (ticket block, query block), both sides bounded.
    """
    spark = queries.sparkSession
    tables = tables or Tables(spark, "lexical-blocks")
    query_terms = tables.store(_suffix_norms(queries, "query_id"), "query_terms", "zstd")
    terms = query_terms.select("term").distinct()
    heads, block_terms = _of_terms(heads, terms), _of_terms(block_terms, terms)
    floors = tables.store(_floors(query_terms, heads, k), "floors")
    floor = F.coalesce("floor", F.lit(0.0)) - SLACK
    able = (
        query_terms.join(floors, "query_id", "left")
        .where(F.col("rest") >= floor)
        .select("query_id", "term", "rest", floor.alias("floor"))
    )
    visits = tables.store(
        salted_join(able, block_terms, "term", "query_id", "inner")
        .where(F.col("rest") * F.col("longest") >= F.col("floor"))
        .select("query_id", "ticket_block")
        .distinct(),
        "visits",
    )
    # Every query block gets a copy of its ticket block, so there are no more of them than it takes to keep all cores busy.
    block_queries *= max(1, min(BLOCK_GROWTH, blocks // spark.sparkContext.defaultParallelism))
    # One row per ticket block, and no more blocks than MAX_BROADCAST_BLOCKS are broadcast.
    asked = visits.groupBy("ticket_block").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_queries)).cast("int").alias("query_blocks")
    )
    if blocks <= MAX_BROADCAST_BLOCKS:
        asked = F.broadcast(asked)
    keys = ["ticket_block", "query_block"]
    each_query_block = F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))
    tickets = (
        forward.withColumn("ticket_block", _in_block("ticket_id", blocks))
        .join(asked, "ticket_block")
        .withColumn("query_block", each_query_block)
        .select(*keys, "ticket_id", "terms", "weights")
    )
    visitors = (
        visits.join(asked, "ticket_block")
        .withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")).cast("int"))
        .select("query_id", *keys)
    )
    # A query may visit very many blocks, and each visit carries its terms.
    floored = queries.join(floors, "query_id", "left")
    visitors = salted_join(visitors, floored, "query_id", "ticket_block", "inner")
    return cogroup_hits(tickets, visitors, keys, k, LexicalCandidates, positive_only=True)


def lexical_top_k(
    forward: DataFrame,
    queries: DataFrame,
    k: int,
    guide: tuple[int, DataFrame, DataFrame] | None = None,
    broadcast_queries: int = BROADCAST_QUERIES,
    block_postings: int = BLOCK_POSTINGS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``(query_id, rank, ticket_id, similarity_score)`` of tickets sharing a term, exact.

    Few queries are size-checked and broadcast while the tickets stream past; more
    take :func:`block_hits` in waves, which run at once. ``guide`` is ``(blocks, heads, block_terms)`` of a
    stored index.
    """
    forward = forward.select(
        F.col("ticket_id").cast("string").alias("ticket_id"), "terms", "weights"
    )
    queries = queries.select(F.col("query_id").cast("string").alias("query_id"), "terms", "weights")
    queries = materialize(queries)
    n_queries = queries.count()
    exploded = queries.select(F.explode("terms").alias("term"))
    small = n_queries <= broadcast_queries and text_bytes(exploded, "term") <= BROADCAST_BYTES
    if small:
        hits = scan_hits(forward, queries.toArrow(), k, LexicalCandidates, positive_only=True)
        return _ranked(hits, k)
    spark = queries.sparkSession
    tables = Tables(spark, "lexical-blocks")
    if guide is None:
        forward = tables.store(_asked_terms_only(forward, exploded.distinct()), "tickets", "zstd")
        blocks = ticket_blocks(forward, block_postings)
        heads, block_terms = guides(forward, blocks)
        guide = (blocks, tables.store(heads, "heads", "zstd"), tables.store(block_terms, "block_terms", "zstd"))
    # Waves of queries one after the other: what is moved for one is deleted before the next, and its best k are kept.
    waves, found = max(1, -(-_postings(queries) // WAVE_POSTINGS)), []
    for wave in range(waves):
        asked = queries.where(_in_block("query_id", waves) == wave)
        hits = block_hits(forward, asked, k, *guide, block_queries, tables)
        tables.store(_ranked(hits, k), "hits")
        found.append(tables.paths["hits"])
        tables.drop("query_terms", "floors", "visits")
    tables.drop(*(tables.paths.keys() - {"hits"}))
    return spark.read.parquet(*found)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    return top_k_per_query(hits, k).select("query_id", "rank", "ticket_id", "similarity_score")


def fill_to_k(ranked: DataFrame, query_ids: DataFrame, first_ids: list[str], k: int) -> DataFrame:
    """Tickets without a shared term, at score 0.0, up to k per query.

    ``first_ids`` are the smallest ``2 * MAX_TOP_K`` ticket ids of the corpus (or
    all, if fewer): a query short of k tickets holds under k of them, so the rest
    of its list is among these.
    """
    # Read twice below.
    ranked = materialize(ranked)
    found = ranked.groupBy("query_id").agg(F.collect_list("ticket_id").alias("have"))
    have = F.coalesce("have", F.array().cast("array<string>"))
    missing = F.array_except(F.lit(first_ids).cast("array<string>"), have)
    room = F.greatest(F.lit(k) - F.size(have), F.lit(0))
    padding = (
        query_ids.select(F.col("query_id").cast("string").alias("query_id"))
        .join(found, "query_id", "left")
        .select(
            "query_id",
            F.size(have).alias("base"),
            F.posexplode(F.slice(missing, F.lit(1), room)).alias("pos", "ticket_id"),
        )
        .select(
            "query_id",
            (F.col("base") + F.col("pos") + 1).alias("rank"),
            "ticket_id",
            F.lit(0.0).alias("similarity_score"),
        )
    )
    return ranked.unionByName(padding)
