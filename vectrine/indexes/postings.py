"""BM25 index of one text: postings and document counts as Parquet."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from copy import copy
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..commits import Commits
from ..functions.text import query_terms, term_counts, tokens
from ..functions.vectors import rounded
from ..operators.bm25 import DIGITS, counted, term_weight
from ..operators.filters import IN_LIST_LIMIT, Condition, apply_filter, in_partitions
from ..operators.knn import SCORE
from ..operators.projection import Output, output_columns
from ..sources.table import SOURCE

DOCUMENTS_PER_BUCKET = 1_000_000
POSTINGS_PER_TASK = 1_000_000
LEAST_BUCKETS = 8
BUCKET = "__bucket"
# The source of rows that belong to no versioned table.
ANYWHERE = ""
# Documents of like length and by hash: the unit that a top-k search reads or passes over.
BLOCK = "__block"
# A number of the key alone that the documents of a block share.
SPLIT = "__split"
LENGTH_CLASSES = 16
FIRST_BLOCKS = 16
MOST_ROUND_BLOCKS = 1024


def postings_of(df: DataFrame, key: str, column: str | Column, places: bool = False) -> DataFrame:
    """(key, term, tf, length[, places][, source][, split]): one row per document and distinct token, counted inside the row."""
    text = F.col(column) if isinstance(column, str) else column
    kept = [F.col(f"`{c}`") for c in (key, SOURCE, SPLIT) if c in df.columns]
    counted = df.select(*kept, term_counts(text, places).alias("__c"))
    exploded = counted.select(*kept, F.col("__c.length").alias("length"), F.explode("__c.terms").alias("__t"))
    return exploded.select(kept[0], "__t.term", "__t.tf", "length", *(["__t.places"] if places else []), *kept[1:])


class TextIndex:
    """Postings cut into folders by a hash of the term and sorted by term.

    A search reads only the folders of its terms, and within them only the row
    groups that can hold the term. Frequent terms fill several files: the layout
    shuffle splits oversized partitions instead of binding a term to one task.

    An index of a versioned table (rows with the column ``SOURCE``) knows which of
    the table's folders it covers. Folders are never changed, so a refresh adds
    the postings of new ones, and those of folders that are gone are passed over.

    With ``block_documents`` documents are dealt into blocks of about that size and
    like length, and the largest count and least length of every term in every block
    are stored beside the postings: a top-k search then passes over blocks that cannot
    reach the result. With ``positions`` postings hold the places of the tokens, for
    phrases.
    """

    RESERVED = ("term", "tf", "length", "places", BLOCK, BUCKET, SOURCE, SPLIT)

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._commits = Commits(spark, self.path)
        version = self._commits.version()
        if version < 0:
            raise ValueError(f"no text index at {path}")
        self.version = version
        self.state = self._commits.read(version)
        self.key, self.columns, self.buckets = self.state["key"], self.state["columns"], self.state["buckets"]
        self.held: list[str] | None = None
        self.fresh: DataFrame | None = None

    def at(self, df: DataFrame, sources: Sequence[str]) -> TextIndex:
        """The index for a table as it is now: ``df`` holds its rows with ``SOURCE``, from the folders ``sources``."""
        if ANYWHERE in self.state["sources"]:
            raise ValueError("the index was not built from a versioned table")
        out = copy(self)
        missing = [s for s in sources if s not in self.state["sources"]]
        out.held, out.fresh = list(sources), df.filter(F.col(SOURCE).isin(missing)) if missing else None
        return out

    # --- building -----------------------------------------------------------------

    @classmethod
    def build(
        cls, df: DataFrame, path: str, key: str, column: str | Sequence[str], buckets: int | None = None, *, block_documents: int | None = None, positions: bool = False
    ) -> TextIndex:
        """Index the whole table; an existing index at ``path`` gets a new version.

        Several columns are read as one text, joined by spaces.
        """
        if key in cls.RESERVED:
            raise ValueError(f"{key!r} is a name the index uses itself")
        columns = [column] if isinstance(column, str) else list(column)
        documents = df.count() if buckets is None or block_documents else 0
        if buckets is None:
            buckets = max(LEAST_BUCKETS, documents // DOCUMENTS_PER_BUCKET)
        splits = max(1, documents // (block_documents * LENGTH_CLASSES)) if block_documents else None
        state = {"key": key, "columns": columns, "buckets": buckets, "parts": [], "sources": {}, "positions": positions}
        state |= {"block_documents": block_documents, "splits": splits}
        return cls._append(df, path, state)

    @staticmethod
    def _text(columns: Sequence[str]) -> Column:
        return F.col(f"`{columns[0]}`") if len(columns) == 1 else F.concat_ws(" ", *[F.col(f"`{c}`") for c in columns])

    @classmethod
    def _append(cls, df: DataFrame, path: str, state: dict, kept: DataFrame | None = None) -> TextIndex:
        """Commit ``state`` with the postings of ``df`` (beside those of ``kept``) as one more part."""
        spark, commits = df.sparkSession, Commits(df.sparkSession, path)
        part = uuid.uuid4().hex
        folder = f"{commits.root}/{part}"
        key, text = state["key"], cls._text(state["columns"])
        rows = df if SOURCE in df.columns else df.withColumn(SOURCE, F.lit(ANYWHERE))
        state = {**state, "parts": [*state["parts"], part], "key_type": df.schema[key].dataType.simpleString()}
        cls._write_postings(rows, folder, state, kept)
        return cls._documents_of(rows, folder, state, commits, spark)

    @classmethod
    def _write_postings(cls, docs: DataFrame, folder: str, state: dict, kept: DataFrame | None = None) -> None:
        """Postings (of ``docs``, and those ``kept``) by bucket, term and block; then what bounds a term's weight in each block."""
        key, text = state["key"], cls._text(state["columns"])
        postings = postings_of(docs, key, text, state["positions"])
        rows = cls._placed(postings if kept is None else postings.unionByName(kept), state)
        order = [BUCKET, "term", *([BLOCK] if state["splits"] else [])]
        rows.hint("rebalance", BUCKET).sortWithinPartitions(*order).write.partitionBy(BUCKET).parquet(f"{folder}/postings")
        if state["splits"]:
            tasks = cls._read_part(docs.sparkSession, folder, state, "postings").count() // POSTINGS_PER_TASK + 1
            most = cls._bounds(docs, state, tasks, kept)
            most.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "term").write.partitionBy(BUCKET).parquet(f"{folder}/bounds")

    @staticmethod
    def _split(state: Mapping) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{state['key']}`")), F.lit(state["splits"]))

    @classmethod
    def _placed(cls, postings: DataFrame, state: dict) -> DataFrame:
        """Postings with their bucket and block."""
        rows = postings.withColumn(BUCKET, cls._bucket(F.col("term"), state["buckets"]))
        if not state["splits"]:
            return rows
        # lengths of one class differ by a fifth at most, so that a block's least length says much
        like = F.floor(F.log2(F.col("length").cast("double")) * 4).cast("long")
        return rows.withColumn(BLOCK, like * F.lit(1 << 32) + cls._split(state))

    @classmethod
    def _bounds(cls, docs: DataFrame, state: dict, tasks: int, kept: DataFrame | None = None) -> DataFrame:
        """Per term, block and source: its rows, largest count and least length.

        Hardly any two postings share a block, so grouping them takes memory for most
        rows of a task. Stored postings are dense, and a task would read very many; so
        the texts are dealt by a number that a block's documents share, to ``tasks``
        tasks, and each groups what it has cut itself.
        """
        key, text = state["key"], cls._text(state["columns"])
        split = cls._split(state)
        if kept is None:
            rows = postings_of(docs.withColumn(SPLIT, split).repartition(tasks, SPLIT), key, text)
        else:
            rows = postings_of(docs, key, text).unionByName(kept.drop("places")).withColumn(SPLIT, split).repartition(tasks, SPLIT)
        grouped = cls._placed(rows, state).groupBy(SPLIT, BUCKET, "term", BLOCK, SOURCE)
        return grouped.agg(F.count("*").alias("rows"), F.max("tf").alias("tf"), F.min("length").alias("length")).drop(SPLIT)

    @classmethod
    def _documents_of(cls, rows: DataFrame, folder: str, state: dict, commits: Commits, spark: SparkSession) -> TextIndex:
        text = F.coalesce(cls._text(state["columns"]), F.lit(""))
        digest = [F.xxhash64(text).alias("digest"), F.length(text).alias("chars")]
        rows.select(F.col(f"`{state['key']}`"), SOURCE, *digest).write.parquet(f"{folder}/documents")
        sizes = cls._read_part(spark, folder, state, "documents").groupBy(SOURCE).agg(F.count("*").alias("n"))
        words = cls._read_part(spark, folder, state, "postings").groupBy(SOURCE).agg(F.sum("tf").alias("t"))
        found = {r[SOURCE]: [r["n"], r["t"] or 0] for r in sizes.join(words, SOURCE, "left").collect()}  # a row per folder
        commits.write(commits.version() + 1, {**state, "sources": {**state["sources"], **found}})
        return cls(spark, commits.root)

    @staticmethod
    def _bucket(term: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")

    def rebuild(self, df: DataFrame) -> TextIndex:
        """A full new version from the current table."""
        options = {"block_documents": self.state.get("block_documents"), "positions": self.state.get("positions", False)}
        return self.build(df, self.path, self.key, self.columns, self.buckets, **options)

    def refresh(self, df: DataFrame, sources: Sequence[str] | None = None) -> TextIndex:
        """A new version that cuts only new and changed texts into tokens.

        With the table's ``sources`` only the rows of folders not covered yet are
        read; else texts are compared by their digests with those indexed.
        """
        if sources is not None and ANYWHERE not in self.state["sources"]:
            fresh = [s for s in sources if s not in self.state["sources"]]
            state = {**self.state, "sources": {s: v for s, v in self.state["sources"].items() if s in set(sources)}}
            return self._append(df.filter(F.col(SOURCE).isin(fresh)), self.path, state)
        identity = [self.key, "digest", "chars"]
        text = F.coalesce(self._text(self.columns), F.lit(""))
        now = df.select(F.col(f"`{self.key}`"), F.xxhash64(text).alias("digest"), F.length(text).alias("chars"))
        before = self.documents()
        gone = before.join(now, identity, "left_anti").select(self.key)
        new = now.join(before, identity, "left_anti").select(self.key)
        kept = self._read("postings").join(gone, self.key, "left_anti").drop(BLOCK, BUCKET).withColumn(SOURCE, F.lit(ANYWHERE))
        added = df.drop(SOURCE).join(new, self.key, "left_semi")
        return self._replace(df.drop(SOURCE), added, kept)

    def _replace(self, df: DataFrame, added: DataFrame, kept: DataFrame) -> TextIndex:
        """One part from postings kept and rows added; the documents are those of ``df``."""
        state = {**self.state, "parts": [], "sources": {}}
        commits = Commits(self.spark, self.path)
        part = uuid.uuid4().hex
        folder = f"{commits.root}/{part}"
        now = {**state, "key_type": df.schema[self.key].dataType.simpleString()}
        self._write_postings(added.withColumn(SOURCE, F.lit(ANYWHERE)), folder, now, kept)
        state["parts"] = [part]
        return self._documents_of(df.withColumn(SOURCE, F.lit(ANYWHERE)), folder, state, commits, self.spark)

    # --- reading ------------------------------------------------------------------

    @staticmethod
    def _read_part(spark: SparkSession, folder: str, state: Mapping, part: str) -> DataFrame:
        key = f"`{state['key']}` {state['key_type']}"
        more = ("places array<int>, " if state.get("positions") else "") + f"{SOURCE} string, " + (f"{BLOCK} long, " if state.get("splits") else "")
        schemas = {
            "postings": f"{key}, term string, tf long, length int, {more}{BUCKET} int",
            "bounds": f"term string, {BLOCK} long, {SOURCE} string, rows long, tf long, length int, {BUCKET} int",
            "documents": f"{key}, {SOURCE} string, digest long, chars int",
        }
        return spark.read.schema(schemas[part]).parquet(f"{folder}/{part}")

    def _read(self, part: str, sources: Sequence[str] | None = None) -> DataFrame:
        """All parts; only rows of these sources, or of all that the index counts."""
        rows = reduce(DataFrame.unionByName, [self._read_part(self.spark, f"{self.path}/{f}", self.state, part) for f in self.state["parts"]])
        wanted = list(self.state["sources"]) if sources is None else [s for s in sources if s in self.state["sources"]]
        return rows.filter(F.col(SOURCE).isin(wanted)) if wanted != [ANYWHERE] else rows

    def covered(self, sources: Sequence[str]) -> list[str]:
        return [s for s in sources if s in self.state["sources"]]

    def postings(self) -> DataFrame:
        """(key, term, tf, length)."""
        return self._read("postings").select(self.key, "term", "tf", "length")

    def terms(self) -> DataFrame:
        """(term, df, cf): documents holding the term and its occurrences."""
        return self._read("postings").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))

    def documents(self) -> DataFrame:
        return self._read("documents").drop(SOURCE)

    def statistics(self) -> DataFrame:
        """One row: documents, tokens, mean document length and terms."""
        n, total = self._totals(None)
        return self.terms().agg(
            F.lit(n).cast("long").alias("n_docs"),
            F.coalesce(F.sum("cf"), F.lit(0)).alias("n_tokens"),
            F.lit(total / n if n else 0.0).alias("mean_length"),
            F.count("*").alias("n_terms"),
        )

    def _totals(self, sources: Sequence[str] | None) -> tuple[int, int]:
        counts = self.state["sources"]
        rows = list(counts.values()) if sources is None else [counts[s] for s in sources if s in counts]
        return sum(r[0] for r in rows), sum(r[1] for r in rows)

    def _of_terms(self, part: str, wanted: Sequence[str], sources: Sequence[str] | None) -> DataFrame:
        """Postings or bounds of these terms: only their folders are read."""
        probes = self.spark.createDataFrame([(t,) for t in wanted], "term string")
        # at most one row per query term comes back
        buckets = [r[0] for r in probes.select(self._bucket(F.col("term"), self.buckets)).distinct().collect()]
        return self._read(part, sources).filter(F.col(BUCKET).isin(buckets) & F.col("term").isin(list(wanted)))

    def _corpus(self, wanted: Sequence[str], sources: Sequence[str] | None, fresh: DataFrame | None) -> tuple[Column, Column]:
        """(idf of the column ``term``, mean length): statistics of all documents, the fresh ones included."""
        n, total = self._totals(sources)
        if self.state.get("splits"):
            counts = self._of_terms("bounds", wanted, sources).select("term", "rows")
        else:
            counts = self._of_terms("postings", wanted, sources).select("term", F.lit(1).cast("long").alias("rows"))
        found = {r["term"]: r["df"] for r in counts.groupBy("term").agg(F.sum("rows").alias("df")).collect()}
        if fresh is not None:
            # one pass over the texts that counts these terms only
            holding = [F.coalesce(F.sum((F.col("c.tf")[i] > 0).cast("long")), F.lit(0)) for i in range(len(wanted))]
            more = self._counted(fresh, wanted).agg(F.count("*"), F.coalesce(F.sum("c.length"), F.lit(0)), *holding).first()
            n, total = n + more[0], total + more[1]
            found |= {t: found.get(t, 0) + more[2 + i] for i, t in enumerate(wanted) if more[2 + i]}
        weight = F.lit(0.0)
        for term, df in found.items():
            weight = F.when(F.col("term") == term, math.log(1 + (n - df + 0.5) / (df + 0.5))).otherwise(weight)
        return weight, F.lit(total / n if n else 0.0)

    def _counted(self, fresh: DataFrame, wanted: Sequence[str]) -> DataFrame:
        """(key, c): the length of each text not indexed yet, and how often it holds each of these terms."""
        return fresh.select(F.col(f"`{self.key}`"), counted(self._text(self.columns), wanted).alias("c"))

    def _fresh_hits(self, fresh: DataFrame, wanted: Sequence[str]) -> DataFrame:
        """(key, term, tf, length) of these terms in texts not indexed yet."""
        terms = F.lit(list(wanted)).cast("array<string>")
        pairs = F.transform("c.tf", lambda f, i: F.struct(F.get(terms, i).alias("term"), f.cast("long").alias("tf")))
        held = F.filter(pairs, lambda x: x["tf"] > 0)
        hits = self._counted(fresh, wanted).select(F.col(f"`{self.key}`"), F.explode(held).alias("t"), F.col("c.length").alias("length"))
        return hits.select(F.col(f"`{self.key}`"), "t.term", "t.tf", "length")

    def _in_blocks(self, rows: DataFrame, blocks: Sequence[int] | DataFrame | None) -> DataFrame:
        if blocks is None:
            return rows
        return rows.join(blocks.select(BLOCK), BLOCK, "left_semi") if isinstance(blocks, DataFrame) else rows.filter(F.col(BLOCK).isin(list(blocks)))

    def scores(
        self,
        text: str,
        digits: int | None = DIGITS,
        *,
        sources: Sequence[str] | None = None,
        fresh: DataFrame | None = None,
        blocks: Sequence[int] | DataFrame | None = None,
        corpus: tuple[Column, Column] | None = None,
    ) -> DataFrame:
        """(key, score) of every document holding a query term; of these ``blocks`` only, if given.

        ``sources`` limits the index to folders the table still has; ``fresh`` are
        the table's rows in folders the index does not cover, counted in place.
        """
        sources, fresh = self.held if sources is None else sources, self.fresh if fresh is None else fresh
        wanted = query_terms(self.spark, text)
        idf, mean_length = corpus or self._corpus(wanted, sources, fresh)
        hits = self._in_blocks(self._of_terms("postings", wanted, sources), blocks).select(self.key, "term", "tf", "length")
        if fresh is not None:
            hits = hits.unionByName(self._fresh_hits(fresh, wanted))
        part = idf * term_weight(F.col("tf"), F.col("length"), mean_length)
        return hits.groupBy(self.key).agg(rounded(F.sum(part), digits).alias(SCORE))

    def block_bounds(self, text: str, *, sources: Sequence[str] | None = None, fresh: DataFrame | None = None, corpus: tuple[Column, Column] | None = None) -> DataFrame:
        """(block, bound): no document of the block scores more.

        A term weighs the more, the more often it occurs and the shorter the text is; so
        a block's largest count and least length bound it, whatever the mean length is.
        """
        wanted = query_terms(self.spark, text)
        idf, mean_length = corpus or self._corpus(wanted, sources, fresh)
        most = self._of_terms("bounds", wanted, sources).groupBy(BLOCK, "term").agg(F.max("tf").alias("tf"), F.min("length").alias("length"))
        weight = idf * term_weight(F.col("tf"), F.col("length"), mean_length)
        return most.groupBy(BLOCK).agg(F.sum(weight).alias("bound"))

    def blocks_for(
        self,
        text: str,
        k: int,
        *,
        allowed: DataFrame | None = None,
        threshold: float | None = None,
        digits: int | None = DIGITS,
        sources: Sequence[str] | None = None,
        fresh: DataFrame | None = None,
        corpus: tuple[Column, Column] | None = None,
    ) -> list[int] | DataFrame | None:
        """The blocks that can hold one of the ``k`` best documents (among the keys ``allowed``); None for all.

        First the blocks with the highest bounds are scored, twice as many each round,
        until the next bound lies below the ``k``-th best score found; then every block
        with a bound at or above that score is named. A round reads its own blocks only
        and returns at most ``k`` scores.
        """
        if not self.state.get("splits"):
            return None
        corpus = corpus or self._corpus(query_terms(self.spark, text), sources, fresh)
        bounds = self.block_bounds(text, sources=sources, corpus=corpus)
        highest = [(r["bound"], r[BLOCK]) for r in bounds.orderBy(F.desc("bound"), BLOCK).limit(MOST_ROUND_BLOCKS).collect()]
        slack = 1e-9 + (0.0 if digits is None else 10.0**-digits)
        least, best, at, step = -1.0 if threshold is None else threshold, [], 0, FIRST_BLOCKS
        while at < len(highest) and highest[at][0] + slack >= least:
            some = [b for _, b in highest[at : at + step]]
            at, step = at + step, 2 * step
            found = self.scores(text, digits, sources=sources, blocks=some, corpus=corpus)
            if allowed is not None:
                found = found.join(allowed.select(self.key), self.key, "left_semi")
            best = sorted(best + [r[SCORE] for r in found.orderBy(F.desc(SCORE)).limit(k).select(SCORE).collect()], reverse=True)[:k]
            if len(best) == k:
                least = max(least, best[-1])
        if least < 0:
            return None
        enough = [b for bound, b in highest if bound + slack >= least]
        if len(enough) < MOST_ROUND_BLOCKS and len(enough) <= IN_LIST_LIMIT:
            return enough
        return bounds.filter(F.col("bound") + F.lit(slack) >= F.lit(float(least)))

    def phrase(self, text: str, *, sources: Sequence[str] | None = None, fresh: DataFrame | None = None) -> DataFrame:
        """Keys of the documents in which the tokens of ``text`` follow each other.

        Every place of a token says where the phrase would begin; a beginning that all
        tokens name is one. ``sources`` and ``fresh`` are those of ``scores``.
        """
        if not self.state.get("positions"):
            raise ValueError("this index holds no positions")
        said = self.spark.range(1).select(tokens(F.lit(text)).alias("t")).first()["t"]
        if not said:
            raise ValueError("a phrase needs a word")
        wanted = list(dict.fromkeys(said))
        hits = self._of_terms("postings", wanted, sources).select(self.key, "term", "places")
        if fresh is not None:
            new = postings_of(fresh.drop(SOURCE), self.key, self._text(self.columns), True)
            hits = hits.unionByName(new.filter(F.col("term").isin(wanted)).select(self.key, "term", "places"))
        offsets = F.lit(None).cast("array<int>")
        for t in wanted:
            offsets = F.when(F.col("term") == t, F.array(*[F.lit(i) for i, x in enumerate(said) if x == t])).otherwise(offsets)
        begins = F.flatten(F.transform("places", lambda p: F.transform(F.col("offsets"), lambda o: p - o)))
        starts = hits.withColumn("offsets", offsets).select(self.key, F.explode(begins).alias("start"))
        return starts.groupBy(self.key, "start").agg(F.count("*").alias("n")).filter(F.col("n") == len(said)).select(self.key).distinct()

    def matching(self, text: str, *, sources: Sequence[str] | None = None, fresh: DataFrame | None = None) -> DataFrame:
        """Keys of the documents that hold any token of ``text``."""
        return self.scores(text, None, sources=sources, fresh=fresh, corpus=(F.lit(0.0), F.lit(1.0))).select(self.key)

    def search(
        self,
        df: DataFrame,
        text: str,
        k: int = 10,
        *,
        where: Condition | None = None,
        threshold: float | None = None,
        partitions: Sequence[str] | None = None,
        names: Sequence[str] | None = None,
        columns: Output | Sequence[Output] | None = None,
        extra: Sequence[Output] | None = None,
        with_score: bool = False,
        digits: int | None = DIGITS,
        sources: Sequence[str] | None = None,
        prune: bool = True,
    ) -> DataFrame:
        """Top ``k`` rows of the table ``df`` by BM25, ties by key.

        An index with blocks reads only those that can reach the result (``prune``).

        Only rows that ``df`` has now are ranked, before the cut to ``k``. With the
        table's ``sources`` the result is that of an index built anew: folders that
        are gone are passed over, and new ones are counted in place.
        """
        output = output_columns([c for c in df.columns if c != SOURCE], names, columns, extra)
        tracked = sources is not None and ANYWHERE not in self.state["sources"]
        fresh = None
        if tracked:
            missing = [s for s in sources if s not in self.state["sources"]]
            fresh = df.filter(F.col(SOURCE).isin(missing)) if missing else None
        held = sources if tracked else None
        allowed = None
        if where is not None or partitions is not None or not tracked:
            allowed = apply_filter(in_partitions(df, partitions), where).select(self.key)
        corpus = self._corpus(query_terms(self.spark, text), held, fresh)
        blocks = None
        if prune:
            blocks = self.blocks_for(text, k, allowed=allowed, threshold=threshold, digits=digits, sources=held, corpus=corpus)
        found = self.scores(text, digits, sources=held, fresh=fresh, blocks=blocks, corpus=corpus).withColumnRenamed(SCORE, "__bm25")
        if threshold is not None:
            found = found.filter(F.col("__bm25") >= F.lit(float(threshold)))
        order = [F.col("__bm25").desc_nulls_last(), F.col(self.key).asc()]
        if allowed is not None:
            found = found.join(allowed, self.key, "left_semi")
        best = found.orderBy(*order).limit(k)
        if with_score:
            output.append(F.col("__bm25").alias(SCORE))
        if k <= IN_LIST_LIMIT:
            # at most k rows come back; their keys reach the scan of the table
            rows = best.collect()
            best = F.broadcast(self.spark.createDataFrame(rows, best.schema))
            df = df.filter(F.col(self.key).isin([r[self.key] for r in rows]) if rows else F.lit(False))
        return df.join(best, self.key).orderBy(*order).limit(k).select(*output)
