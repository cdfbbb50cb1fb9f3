"""BM25 from stored postings: a search reads the lists of its terms, and only the blocks of them that can matter.

Rows of the corpus are dealt into blocks of rows of similar length. What a term adds to a row's score per unit
of query weight is its impact there. The impacts of one term in one block are one stored row, with their
largest value beside them. These rows lie by bucket of the term's hash, range-partitioned by (term, block), so a term
that most rows hold fills several files and a rare one shares a file.

A search (``by_blocks``) brings the asked lists of a block together in one task and scores the block's rows for all
queries by a matrix product; a task lets out only rows that reach the k best it has seen. Its work follows the lists read, not
the pairs of a query and a row.

``Search`` is the form for few, selective queries. It goes in two steps, each a handful of joins inside the JVM:

1. Threshold. The terms that can add most are looked up first; the best rows they lead to are scored in full. The k-th
   of these scores is a lower bound for the k-th score of the query.
2. Candidates. Taking a query's terms from the one that can add least, those whose largest additions together stay below
   the threshold can't bring a row there alone. Rows are therefore only looked up by the other, essential terms, and only in
   blocks where all terms' largest additions reach the threshold. A row whose sum, with the block's bound for the rest, reaches
   it is scored in full; the rest is never joined.

Both are exact: bounds are widened by a billionth for the order of summation. Corpora that are searched as several
indexes at once (chunk sizes, say) have a ``space`` column: statistics and results are then per space.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from rankloom.operators.lexical import B, K1, LexicalScorer, corpus_stats, query_weights
from rankloom.operators.ranking import by_score
from rankloom.operators.topk import best_positions, query_blocks
from rankloom.scale import BROADCAST_BYTES, BROADCAST_ROWS, through_table

#: Rows of the corpus in a block, about.
BLOCK_ROWS = 512
#: Postings of a file that are aimed at, and most folders that files are dealt to.
FILE_POSTINGS, MOST_BUCKETS = 4_000_000, 1024
#: Up to so many different terms are named in the filter that reaches the scan; beyond it buckets alone are.
NAMED_TERMS = 1000
SLACK = 1e-9


def _bucket(term: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(term), buckets).cast("int")


def _block(corpus: DataFrame, keys: Sequence[str]) -> Column:
    """Numbers of blocks: rows are classed by length (two classes an octave), a class is cut by the key's hash."""
    level = F.floor(F.log2(F.size("terms") + 1) * 2).cast("int")
    counts = sorted(corpus.where(F.size("terms") > 0).groupBy(level).count().collect())  # a few dozen classes
    if not counts:
        return F.lit(0).cast("long")
    slices = {c: math.ceil(n / BLOCK_ROWS) for c, n in counts}
    first, at = {}, 0
    for c, n in slices.items():
        first[c], at = at, at + n

    def looked_up(values: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), level).cast("long")

    return looked_up(first) + F.pmod(F.xxhash64(*keys), looked_up(slices))


def postings(corpus: DataFrame, keys: Sequence[str], space: str | None = None) -> DataFrame:
    """(bucket, term, block, n, most, entries, buckets) of rows (keys, terms): entries are (*keys, impact), most the largest impact.

    Keys tell rows apart. Rows with null or no terms have no postings. With ``space`` terms are counted
    apart for each of its values, which must not be null.
    """
    keys, per = list(keys), [space] if space else []
    total = corpus.agg(F.sum(F.size(F.array_distinct("terms")))).first()[0] or 0
    buckets = F.lit(min(MOST_BUCKETS, max(8, total // FILE_POSTINGS)))
    term = _named(space, F.col("term"))
    of_row = [*per, *keys, "_length", "block"]
    counted = _counted(corpus.select(*per, *keys, F.size("terms").alias("_length"), _block(corpus, keys).alias("block"), "terms"), of_row)
    if not corpus.groupBy(*per, *keys).count().where(F.col("count") > 1).isEmpty():
        counted = counted.groupBy(*of_row, "term").agg(F.sum("_tf").alias("_tf"))
    if space:
        mean = F.broadcast(corpus.groupBy(space).agg(F.avg(F.size("terms")).alias("_mean")))  # one row for each index
        counted = counted.join(mean, space)
    else:
        counted = counted.withColumn("_mean", corpus_stats(corpus).select("avgdl").scalar())
    impact = F.col("_tf") * (K1 + 1) / (F.col("_tf") + K1 * (1 - B + B * F.col("_length") / F.col("_mean")))
    packed = counted.select(term.alias("term"), "block", *keys, impact.alias("impact")).groupBy("term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("impact").alias("most"), F.collect_list(F.struct(*keys, "impact")).alias("entries")
    )
    return packed.withColumn("buckets", buckets).select(_bucket(F.col("term"), F.col("buckets")).alias("bucket"), *packed.columns, "buckets")


def _counted(rows: DataFrame, of_row: list[str]) -> DataFrame:
    """(*of_row, term, _tf): the terms of each row with their counts, made inside the row's task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                terms = batch.column("terms")
                found = terms.flatten().dictionary_encode()
                there = pc.is_valid(found.indices).to_numpy(zero_copy_only=False)
                number = found.indices.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                size = max(len(found.dictionary), 1)
                row = pc.list_parent_indices(terms).to_numpy(zero_copy_only=False)[there].astype(np.int64)
                pair, tf = np.unique(row * size + number, return_counts=True)
                row = pa.array(pair // size)
                columns = [batch.column(c).take(row) for c in of_row]
                term = found.dictionary.take(pa.array(pair % size))
                yield pa.RecordBatch.from_arrays([*columns, term, pa.array(tf.astype(np.int64))], [*of_row, "term", "_tf"])

    schema = [rows.schema[c] for c in of_row]
    schema += [S.StructField("term", S.StringType()), S.StructField("_tf", S.LongType())]
    return rows.mapInArrow(run, S.StructType(schema))


def _named(space: str | None, term: Column) -> Column:
    return F.concat_ws("\x01", F.col(space).cast("string"), term) if space else term


def store(rows: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write postings by bucket, sorted by term and block, and read them back; ``files`` as measured if not given."""
    if files is None:
        rows = through_table(rows, "postings")
        files = max(1, (rows.agg(F.sum("n")).first()[0] or 0) // FILE_POSTINGS)
    dealt = rows.repartitionByRange(files, "bucket", "term", "block").sortWithinPartitions("bucket", "term", "block")
    dealt.write.partitionBy("bucket").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def asked_for(held: DataFrame, asked: DataFrame, terms: int | None = None) -> DataFrame:
    """The stored rows that queries (term) can touch, by filters that prune the scan; ``terms`` bounds their number if it is known."""
    one = held.select("buckets").first()
    if one is None:
        return held
    buckets = [r[0] for r in asked.select(_bucket(F.col("term"), F.lit(one[0]))).distinct().collect()]  # at most MOST_BUCKETS
    found = held.where(F.col("bucket").isin(buckets))
    if terms is not None and terms > 10 * NAMED_TERMS:  # queries share terms, but hardly so many
        return found
    names = [r[0] for r in asked.select("term").distinct().limit(NAMED_TERMS + 1).collect()]
    return found.where(F.col("term").isin(names)) if len(names) <= NAMED_TERMS else found


class Search:
    """One search: the frames of its steps, so that tests can count what each of them touches.

    ``asked``: (query_id, term, weight), one row for each term of a query.
    """

    def __init__(self, asked: DataFrame, held: DataFrame, k: int, keys: Sequence[str]):
        self.k, self.keys = k, list(keys)
        self.asked = through_table(asked, "asked-terms")
        size = F.sum(F.length(F.to_json(F.struct("*"))))
        self.n, bytes_ = self.asked.agg(F.count(F.lit(1)), size).first()
        self.small = self.n <= BROADCAST_ROWS and (bytes_ or 0) <= BROADCAST_BYTES
        self.rows = asked_for(held, self.asked, self.n)
        self.opened: list[DataFrame] = []

    def _hint(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """What is no larger than the queries' terms, or has so many rows, is broadcast if that is small."""
        small = self.small if rows is None else rows <= BROADCAST_ROWS
        return F.broadcast(df) if small else df

    def _entries(self, wanted: DataFrame, on: list[str], *keep: str) -> DataFrame:
        """The postings of the wanted lists, one row each."""
        opened = self.rows.join(wanted, on).select("term", "block", *keep, F.inline("entries"))
        self.opened.append(opened)
        return opened

    def _in_full(self, rows: DataFrame, terms: DataFrame, n: int) -> DataFrame:
        """(query_id, *keys, score): stored rows (query_id, block, *keys, partial) with what ``terms`` add to them.

        ``n`` bounds the number of pairs of a row and a term.
        """
        needs = rows.select("query_id", "block", *self.keys).join(self._hint(terms), "query_id")
        entries = self._entries(self._hint(needs.select("term", "block").distinct(), n), ["term", "block"])
        joined = entries.join(self._hint(needs, n), ["term", "block", *self.keys])
        added = joined.select("query_id", *self.keys, (F.col("weight") * F.col("impact")).alias("partial"))
        both = rows.select("query_id", *self.keys, "partial").unionByName(added)
        return both.groupBy("query_id", *self.keys).agg(F.sum("partial").alias("score"))

    def bounds(self) -> DataFrame:
        """(query_id, term, block, weight, n, bound): the most that a list adds to a row of its block."""
        heads = self.rows.select("term", "block", "n", "most").join(self._hint(self.asked), "term")
        bound = F.greatest(F.col("weight"), F.lit(0.0)) * F.col("most")
        return through_table(heads.select("query_id", "term", "block", "weight", "n", bound.alias("bound")), "term-bounds")

    def threshold(self, terms: DataFrame) -> DataFrame:
        """(query_id, least): a lower bound of the k-th score, for queries whose strongest terms lead to k rows."""
        strongest = Window.partitionBy("query_id").orderBy(F.desc("bound"), "term")
        before = F.coalesce(F.sum("df").over(strongest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        marked = terms.withColumn("first", before < 2 * self.k)
        first = self._hint(marked.where("first").select("query_id", "term", "weight"))
        found = self._entries(first, ["term"], "query_id", "weight")
        part = found.groupBy("query_id", "block", *self.keys).agg(F.sum(F.col("weight") * F.col("impact")).alias("partial"))
        best = Window.partitionBy("query_id").orderBy(F.desc("partial"), *self.keys)
        rows = part.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= 2 * self.k).drop("_at")
        rows = through_table(rows, "first-rows")
        full = self._in_full(rows, marked.where("not first").select("query_id", "term", "weight"), 2 * self.k * self.n)
        at = Window.partitionBy("query_id").orderBy(F.desc("score"))
        kth = full.withColumn("_at", F.row_number().over(at)).where(F.col("_at") == self.k)
        return kth.select("query_id", (F.col("score") - F.abs("score") * SLACK - SLACK).alias("least"))

    def candidates(self, bounds: DataFrame, terms: DataFrame, least: DataFrame) -> tuple[DataFrame, DataFrame]:
        """((query_id, block, *keys, partial), the terms that are still to be added to them)."""
        weakest = Window.partitionBy("query_id").orderBy("bound", "term")
        together = F.sum("bound").over(weakest)
        split = terms.join(self._hint(least), "query_id", "left").withColumn(
            "essential", F.col("least").isNull() | (together >= F.col("least"))
        )
        split = through_table(split.select("query_id", "term", "weight", "essential", "least"), "essential-terms")
        known = bounds.drop("weight").join(self._hint(split), ["query_id", "term"])
        rest = F.sum(F.when(~F.col("essential"), F.col("bound")).otherwise(0.0))
        live = known.groupBy("query_id", "block").agg(
            rest.alias("rest"), F.sum("bound").alias("all"), F.first("least").alias("least"), F.max("essential").alias("any")
        )
        live = live.where(F.col("any") & (F.col("least").isNull() | (F.col("all") >= F.col("least")))).select("query_id", "block", "rest")
        wanted = known.where("essential").select("query_id", "term", "block", "weight", "least").join(live, ["query_id", "block"])
        wanted = through_table(wanted, "essential-lists")
        found = self._entries(self._hint(wanted, wanted.count()), ["term", "block"], "query_id", "weight", "rest", "least")
        part = found.groupBy("query_id", "block", *self.keys).agg(
            F.sum(F.col("weight") * F.col("impact")).alias("partial"), F.first("rest").alias("rest"), F.first("least").alias("least")
        )
        rows = part.where(F.col("least").isNull() | (F.col("partial") + F.col("rest") >= F.col("least")))
        return through_table(rows.drop("rest", "least"), "candidates"), split.where("not essential").select("query_id", "term", "weight")

    def run(self) -> DataFrame:
        bounds = self.bounds()
        terms = bounds.groupBy("query_id", "term").agg(F.first("weight").alias("weight"), F.max("bound").alias("bound"), F.sum("n").alias("df"))
        terms = through_table(terms, "asked-bounds")
        rows, rest = self.candidates(bounds, terms, self.threshold(terms))
        longest = rest.groupBy("query_id").count().agg(F.max("count")).first()[0] or 0
        return self._in_full(rows, rest, rows.count() * longest)


def _rows_of(flat: pa.StructArray, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of each entry's row, in the order of keys; an entry of each row)."""
    named = pa.table([flat.field(key) for key in keys], names=keys)
    order = pc.sort_indices(named, [(key, "ascending") for key in keys]).to_numpy()
    first = np.zeros(len(order), bool)
    first[:1] = True
    for key in keys:
        codes = flat.field(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[order]
        first[1:] |= codes[1:] != codes[:-1]
    row = np.empty(len(order), np.int64)
    row[order] = np.cumsum(first) - 1
    return row, order[first]


def by_blocks(asked: DataFrame, held: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    """(query_id, *keys, score) of the rows that may be among the k best of queries (query_id, term, weight): all that are,
    with their whole scores. The asked lists of a block of rows meet in one task."""
    keys, scorer = list(keys), LexicalScorer()
    asked = through_table(asked.select("query_id", "term", "weight", F.lit(1.0).alias("avgdl")), "asked-terms")
    table = asked.toArrow()
    shared = asked.sparkSession.sparkContext.broadcast(table)
    wanted = F.broadcast(asked.select("term").distinct())
    opened = asked_for(held, asked, table.num_rows).select("block", "term", "entries").join(wanted, "term", "left_semi")

    def scored(blocks: list, parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(parts).combine_chunks()
        lists = pa.concat_arrays(rows.column("entries").chunks)
        flat, of = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        row, one = _rows_of(flat, keys)
        impact = flat.field("impact").to_numpy(zero_copy_only=False)
        for block in blocks:
            term = pc.fill_null(pc.index_in(rows.column("term"), value_set=block.data["vocabulary"]), -1).to_numpy()[of].astype(np.int64)
            at = term >= 0
            total = scorer.totals(block.data, row[at], term[at], impact[at], len(one))
            q, r, rounded = best_positions(total, k)
            keep = block.admit(q, rounded, k)
            q, r = q[keep], r[keep]
            if len(q):
                columns = [block.ids.take(pa.array(q)), *[flat.field(key).take(pa.array(one[r])) for key in keys]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(total[q, r], pa.float64())], ["query_id", *keys, "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, place, parts = query_blocks(scorer, shared.value), None, []
        for batch in batches:
            number = batch.column("block").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for start, stop in zip(edges, edges[1:]):
                if start == stop:
                    continue
                if parts and number[start] != place:
                    yield from scored(blocks, parts)
                    parts = []
                place = number[start]
                parts.append(pa.Table.from_batches([batch.slice(start, stop - start)]))
        if parts:
            yield from scored(blocks, parts)

    entry = held.schema["entries"].dataType.elementType
    fields = [S.StructField("query_id", asked.schema["query_id"].dataType), *[S.StructField(key, entry[key].dataType) for key in keys]]
    together = opened.repartition("block").sortWithinPartitions("block")
    return together.mapInArrow(run, S.StructType([*fields, S.StructField("score", S.DoubleType())]))


def search(
    queries: DataFrame, held: DataFrame, weights: DataFrame, k: int, keys: Sequence[str], text: str = "query", space: str | None = None
) -> DataFrame:
    """(query_id, *keys, score, rank): the k best rows per query; rows sharing no term are no hits.

    ``held`` are stored postings, ``weights`` the term weights of the same corpus. With ``space`` each query is
    asked in every space of ``weights``, and results have its column.
    """
    keys, per = list(keys), [space] if space else []
    asked = query_weights(queries.where(F.col("query_id").isNotNull()), weights, text, per)
    kind = asked.schema["query_id"].dataType
    if space:
        asked = asked.select(_named(space, F.col("query_id").cast("string")).alias("query_id"), _named(space, F.col("term")).alias("term"), "weight")
    scored = by_blocks(asked.select("query_id", "term", "weight"), held, k, keys)
    if space:
        apart = F.split("query_id", "\x01", 2)
        scored = scored.select(apart[0].alias(space), apart[1].cast(kind).alias("query_id"), *keys, "score")
    place = F.row_number().over(Window.partitionBy(*per, "query_id").orderBy(*by_score(keys))).cast("bigint")
    return scored.withColumn("rank", place).where(F.col("rank") <= k)
