"""How the sources of a language differ in their words, with the top terms by dominance skybands.

A task counts the terms of its texts by language and source with byte tables and Arrow
dictionaries and sums its own counts, so a term passes the shuffle at most once a task
and source. One shuffle by (language, term) brings the sources of a term together, which
tells the terms to keep and lets a second aggregate and a window run without another.

Kept terms are dealt into shards of about ``SHARD_ROWS`` counts. A shard has for every source
of its language the term counts, those that are 0 included, and gives

* its part of the sum of share differences for each pair of sources,
* for every source the skyband of its terms: a term is dominated by one that the group has at
  least as often, the language at most as often, and that comes earlier in UTF-8. Its
  difference is then no larger and its rank lower, so a term that ``k`` others dominate is in
  no top ``k``. Skybands of shards are merged by the same rule, and what is left is ranked exactly.

Shares are exact integers: the division runs in three steps of a thousand, so counts may
reach 9e15 words. Sources of one language are dealt in blocks of ``BLOCK_SOURCES``, since
the pairs are as many as the square of their number.

Defined cases: null text, language and source are empty strings, which are values like
any other; a group without terms has the shares of zero counts; a language without kept
terms has differences of 0 and no terms; ties go by the item's UTF-8 bytes; repeated rows are
documents of their own, ids are not read; long texts are whole; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadcast.llm.bpe import LOWER, slices
from roadcast.llm.common import regrouped, stored

BATCH_BYTES = 1 << 20
TASK_ROWS = 200_000  # a task sums its counts when it holds so many rows, and lets them go if so many remain
SHARD_ROWS, CHUNK_CELLS, BLOCK_SOURCES = 100_000, 1 << 20, 256
SMOOTHING, SCALE_STEPS, STEP = 5, 3, 1000
SKY_BLOCK = 256

IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

COUNTS = pa.schema(
    [("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def batch_counts(batch: pa.RecordBatch) -> pa.Table:
    """``lang, term, source, n, docs`` of the texts of one batch."""
    texts = batch.column("text").to_pylist()
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = IS_TERM[raw]
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
    coded = slices(LOWER[raw], starts, ends).dictionary_encode()
    words = max(1, len(coded.dictionary))
    code = coded.indices.to_numpy().astype(np.int64)
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    names = [*zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)]
    groups = {name: i for i, name in enumerate(dict.fromkeys(names))}
    group = np.array([groups[name] for name in names], np.int64)
    cells, n = np.unique(group[doc] * words + code, return_counts=True)
    once = np.unique(doc * words + code)
    _, docs = np.unique(group[once // words] * words + once % words, return_counts=True)
    langs, sources = (pa.array(x, pa.string()) for x in zip(*groups, strict=True))
    of_group = pa.array(cells // words)
    columns = [
        langs.take(of_group),
        coded.dictionary.take(pa.array(cells % words)).cast(pa.large_string()).cast(pa.string()),
        sources.take(of_group),
        pa.array(n, pa.int64()),
        pa.array(docs, pa.int64()),
    ]
    return pa.Table.from_arrays(columns, schema=COUNTS)


def summed(parts: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(parts).group_by(["lang", "term", "source"]).aggregate([("n", "sum"), ("docs", "sum")])
    return table.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(COUNTS.names)


def term_counts(docs: DataFrame) -> DataFrame:
    """Counts by language, term and source, summed within each task."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in regrouped(batches, "text", BATCH_BYTES):
            held.append(batch_counts(batch))
            if sum(t.num_rows for t in held) >= TASK_ROWS:
                held = [summed(held)]
                if held[0].num_rows >= TASK_ROWS // 2:
                    yield from held.pop().to_batches(max_chunksize=65_536)
                    pa.default_memory_pool().release_unused()
        if held:
            yield from summed(held).to_batches(max_chunksize=65_536)

    rows = docs.select("lang", "source", F.encode("text", "UTF-8").alias("text"))
    return rows.mapInArrow(of, "lang string, term string, source string, n long, docs long")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """``lang, term, source, n, lang_n, first``: kept terms by source; ``first`` marks one row of each term."""
    dealt = term_counts(docs).repartition("lang", "term")
    counts = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    rows = counts.select(
        "lang",
        "term",
        "source",
        "n",
        F.sum("n").over(term).alias("lang_n"),
        F.sum("docs").over(term).alias("lang_docs"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    )
    return stored(rows.filter(F.col("lang_docs") >= least_docs).drop("lang_docs"), "kept-terms")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, total, terms, lang_total, nth, last_nth``: every occurring group, ``nth`` its place in the language."""
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_total"))
    groups = docs.select("lang", "source").distinct()
    joined = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    lang = Window.partitionBy("lang")
    filled = joined.fillna(0, ["total", "terms", "lang_total"])
    return filled.select("*", (F.row_number().over(lang.orderBy("source")) - 1).alias("nth"), (F.count("*").over(lang) - 1).alias("last_nth"))


def blocks(last: str) -> Column:
    """A row for each block of sources; ``last`` is the place of the language's last source."""
    return F.explode(F.sequence(F.lit(0), F.floor(F.col(last) / BLOCK_SOURCES).cast("int"))).alias("block")


def shares(counts: np.ndarray, totals: np.ndarray | int) -> np.ndarray:
    """``1 + floor(1e9 * (count + 5) / total)``, exactly; ``total`` is already smoothed and at least ``count + 5``."""
    rest, quotient = counts + SMOOTHING, 0
    for _ in range(SCALE_STEPS):
        rest = rest * STEP
        quotient = quotient * STEP + rest // totals
        rest = rest % totals
    return quotient + 1


def skyband(often: np.ndarray, seldom: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Positions that fewer than ``k`` others dominate: ``often`` not less, ``seldom`` not more, ``place`` before.

    Sorted so that dominators come first. It is enough to count those among the positions kept so far
    and the block at hand: whatever ``k`` others dominate, ``k`` members of the skyband do.
    """
    order = np.lexsort((place, seldom, -often))
    kept = np.empty(0, np.int64)
    for start in range(0, len(order), SKY_BLOCK):
        block = order[start : start + SKY_BLOCK]
        rivals = np.concatenate([kept, block])
        over = (
            (often[rivals] >= often[block, None]) & (seldom[rivals] <= seldom[block, None]) & (place[rivals] < place[block, None])
        )
        kept = np.concatenate([kept, block[over.sum(axis=1) < k]])
    return kept


PARTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string())]
    + [(c, pa.int64()) for c in ("value", "n", "lang_n")]
)
PART_COLUMNS = "lang string, source string, part string, item string, value long, n long, lang_n long"


def part_rows(lang: str, source: str, part: str, items: pa.Array, value, n=None, lang_n=None) -> pa.Table:
    rows = len(items)
    texts = [pa.repeat(pa.scalar(x, pa.string()), rows) for x in (lang, source, part)]
    numbers = [pa.nulls(rows, pa.int64()) if x is None else pa.array(x, pa.int64()) for x in (value, n, lang_n)]
    return pa.Table.from_arrays([*texts, items.cast(pa.string()), *numbers], schema=PARTS)


def audited(k: int):
    """The work on one shard: what its terms add to the pairs, and the skyband of every source of the block."""

    def of(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
        lang, block = key[0].as_py(), key[2].as_py()
        groups = groups.sort_by("nth")
        names = groups.column("source").to_pylist()
        size = int(groups.column("terms")[0].as_py()) * SMOOTHING
        totals = groups.column("total").to_numpy() + size
        lang_total = int(groups.column("lang_total")[0].as_py()) + size
        mine = range(block * BLOCK_SOURCES, min(len(names), (block + 1) * BLOCK_SOURCES))
        terms = terms.sort_by("term")
        coded = terms.column("term").combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy()
        nth = {name: i for i, name in enumerate(names)}
        source = np.array([nth[s] for s in terms.column("source").to_pylist()], np.int64)
        n, lang_n = terms.column("n").to_numpy(), terms.column("lang_n").to_numpy()
        sums = np.zeros((len(mine), len(names)), np.int64)
        width = max(1, CHUNK_CELLS // len(names))
        for start in range(0, len(coded.dictionary), width):
            a, b = np.searchsorted(code, (start, start + width))
            counts = np.zeros((len(names), min(width, len(coded.dictionary) - start)), np.int64)
            counts[source[a:b], code[a:b] - start] = n[a:b]
            share = shares(counts, totals[:, None])
            for row, s in enumerate(mine):
                sums[row] += np.abs(share - share[s]).sum(axis=1)
        found = []
        others = pa.array(names, pa.string())
        for row, s in enumerate(mine):
            rest = np.delete(np.arange(len(names)), s)
            found.append(part_rows(lang, names[s], "pair", others.take(pa.array(rest)), sums[row][rest]))
            own = np.flatnonzero(source == s)
            if len(own):
                value = shares(n[own], totals[s]) - shares(lang_n[own], lang_total)
                own, value = own[value > 0], value[value > 0]
                sky = skyband(n[own], lang_n[own], code[own], k)
                items = coded.dictionary.take(pa.array(code[own[sky]]))
                found.append(part_rows(lang, names[s], "term", items, value[sky], n[own[sky]], lang_n[own[sky]]))
        return pa.concat_tables(found) if found else PARTS.empty_table()

    return of


def merged_skybands(candidates: DataFrame, k: int) -> DataFrame:
    """The skybands of all shards of a group, thinned by the same rule."""

    def of(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("item")
        kept = skyband(rows.column("n").to_numpy(), rows.column("lang_n").to_numpy(), np.arange(rows.num_rows), k)
        return rows.take(pa.array(kept)).select(PARTS.names).cast(PARTS)

    return candidates.groupBy("lang", "source").applyInArrow(of, PART_COLUMNS)


def audit(
    docs: DataFrame,
    least_docs: int = 30,
    top: int = 50,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: all other sources by difference, and the ``top`` terms, of every group."""
    named = ((text_column, "text"), (lang_column, "lang"), (source_column, "source"))
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in named])
    kept = kept_terms(docs, least_docs)
    groups = stored(group_totals(docs, kept), "group-totals")
    shards = 1 + kept.count() // SHARD_ROWS
    shard = F.pmod(F.xxhash64("term"), F.lit(shards))
    places = groups.select(F.col("lang").alias("of"), F.col("nth").alias("place"))
    last = places.groupBy("of").agg(F.max("place").alias("last"))
    dealt = kept.join(last, F.col("lang") == F.col("of"))
    terms = dealt.select(*kept.columns, blocks("last"), shard.cast("int").alias("shard"))
    replicas = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    stats = groups.select("*", blocks("last_nth")).select("*", replicas)
    both = [d.groupBy("lang", "shard", "block") for d in (terms, stats)]
    parts = stored(both[0].cogroup(both[1]).applyInArrow(audited(top), PART_COLUMNS), "audit-parts")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    found = merged_skybands(parts.filter("part = 'term'"), top).select(*pairs.columns)
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    result = pairs.select("*", ranked).unionByName(found.select("*", ranked).filter(F.col("rank") <= top))
    return result.select("lang", "source", "part", "item", "value", "rank")
