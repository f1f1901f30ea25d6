"""Term statistics: counts, TF-IDF, co-occurrence, document similarity."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from pulsegrain.functions import text as tx
from pulsegrain.operators import chunks, pairs
from pulsegrain.operators.match import hot_key_join
from pulsegrain.operators.numbering import number_rows
from pulsegrain.operators.ranking import top_per_group
from pulsegrain.session import removed, shuffles_removed, written


def _tokens(text: str, stopwords: Sequence[str]) -> Column:
    return tx.without(tx.tokens_of(F.col(text)), stopwords)


def token_top_n(df: DataFrame, nouns: str, group: Sequence[str], stopwords: Sequence[str] | DataFrame = (), n: int = 30) -> DataFrame:
    """The most frequent space-separated tokens per group; stopwords and single characters dropped.

    Stopwords come as a list or as a table with a column ``word``.
    """
    tokens = df.select(*group, F.explode(F.split(nouns, r"\s+")).alias("token")).where(F.length("token") > 1)
    if isinstance(stopwords, DataFrame):
        counts = tokens.groupBy(*group, "token").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.join(stopwords, F.col("token") == F.col("word"), "left_anti")
    else:
        if stopwords:
            tokens = tokens.where(~F.col("token").isin(list(stopwords)))
        counts = tokens.groupBy(*group, "token").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, group, [F.desc("n"), F.asc("token")], n)


def term_frequency_top_n(df: DataFrame, text: str, group: Sequence[str] = (), stopwords: Sequence[str] = (), n: int = 20) -> DataFrame:
    """The most frequent terms, over all texts or per group."""
    counts = df.select(*group, F.explode(_tokens(text, stopwords)).alias("term")) \
        .groupBy(*group, "term").agg(F.count(F.lit(1)).alias("n"))
    if group:
        return top_per_group(counts, group, [F.desc("n"), F.asc("term")], n)
    return counts.orderBy(F.desc("n"), "term").limit(n)


def term_counts(df: DataFrame, key: str, text: str, stopwords: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Term counts per document.

    Documents are spread by id before they are split, so the texts are
    shuffled once and the counting needs no further exchange.
    """
    spread = df.select(key, *keep, text).repartition(F.col(key))
    return spread.select(key, *keep, F.explode(_tokens(text, stopwords)).alias("term")) \
        .groupBy(key, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_top_n(df: DataFrame, key: str, text: str, group: str, stopwords: Sequence[str] = (), n: int = 20) -> DataFrame:
    """Terms of a group by their summed TF-IDF weight.

    Per group of N documents: idf = ln((1+N)/(1+df)) + 1, a document's weights
    tf*idf are scaled to length 1 and added up per term. The texts lie in chunks
    by id. Each chunk counts the rows of its terms, asks for its terms' idf
    once, and gives one sum per term, so nothing is sorted, joined or shuffled
    per occurrence, whatever the vocabulary.
    """
    texts = chunks.in_chunks_by_id(df, key, text, _tokens(text, stopwords), [group])
    asked = written(chunks.row_terms(texts, "_tokens", [group]), "chunk-terms")
    # The empty term stands for the document itself, so its frequency is N.
    frequency = asked.groupBy(group, "term").agg(F.sum("n").alias("df"))
    sizes = asked.where(F.col("term") == "").groupBy(group).agg(F.sum("n").alias("docs"))
    # One row per group.
    idf = frequency.where(F.col("term") != "").join(sizes, group).select(
        group, "term", (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1).alias("idf"))
    answers = asked.join(idf, [group, "term"]).select("_chunk", group, "term", "idf")
    kinds = StructType([texts.schema[group], StructField("term", StringType()), StructField("unit", DoubleType())])
    schema = to_arrow_schema(kinds)

    def units(left: pa.Table, right: pa.Table) -> pa.Table:
        return _units(left, right, key, group, schema)

    parts = texts.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(units, kinds)
    scores = parts.groupBy(group, "term").agg(F.round(F.sum("unit"), 6).alias("score"))
    return top_per_group(scores, [group], [F.desc("score"), F.asc("term")], n)


def _units(left: pa.Table, right: pa.Table, key: str, group: str, schema: pa.Schema) -> pa.Table:
    """The weights of a chunk's documents, scaled to length 1, added up per group and term."""
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    # Groups of the answers first, so that a group without an answer has a higher number.
    groups = pa.concat_arrays([chunks.whole(right.column(group)), chunks.whole(left.column(group))]) \
        .dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    terms = chunks.whole(right.column("term")).dictionary_encode()
    size = len(terms.dictionary)
    known = groups[:right.num_rows] * size + terms.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(known)
    known, idf = known[order], right.column("idf").to_numpy()[order]
    ids, _ = chunks.cells_of([chunks.whole(left.column(key))])
    documents, first = chunks.cells_of([chunks.whole(left.column(key)), chunks.whole(left.column(group))])
    at, bounds = chunks.places(left.column("_tokens"), terms.dictionary)
    rows = np.repeat(documents, np.diff(bounds))
    cells, tf = np.unique(rows[at >= 0] * size + at[at >= 0], return_counts=True)
    rows, asked = first[cells // size], groups[right.num_rows:][first[cells // size]] * size + cells % size
    place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    answered = known[place] == asked
    rows, place, weight = rows[answered], place[answered], (tf * idf[place])[answered]
    length = np.sqrt(np.bincount(ids[rows], weights=weight * weight, minlength=len(ids)))
    units = np.bincount(place, weights=weight / length[ids[rows]], minlength=len(known))
    met = np.flatnonzero(np.bincount(place, minlength=len(known)))
    at_row = pa.array(order[met])
    return pa.table([chunks.whole(right.column(group)).take(at_row), chunks.whole(right.column("term")).take(at_row), pa.array(units[met])], schema=schema)


def cooccurrence_score(df: DataFrame, text: str, stopwords: Sequence[str] = ()) -> DataFrame:
    """Per term: over its texts, how many other distinct terms stand beside it.

    This is the row sum of the term-term matrix without its diagonal; no pair
    is ever formed.
    """
    terms = df.select(F.array_distinct(_tokens(text, stopwords)).alias("terms"))
    return terms.select(F.explode("terms").alias("term"), (F.size("terms") - 1).alias("others")) \
        .groupBy("term").agg(F.sum("others").alias("score"))


def cooccurrence_top_n(df: DataFrame, text: str, stopwords: Sequence[str] = (), n: int = 20) -> DataFrame:
    return cooccurrence_score(df, text, stopwords).orderBy(F.desc("score"), "term").limit(n)


def cooccurrence_pairs(df: DataFrame, text: str, n: int = 20, head: int = 512, stopwords: Sequence[str] = ()) -> DataFrame:
    """For every term the ``n`` terms that share most texts with it: term_a, term_b, n, rank; ties by name.

    The whole matrix is counted. Terms are numbered in the order of their
    names, so a pair is one whole number and ties go by number. The texts are
    stored as numbers once. The MATRIX_A_HEAD * ``head`` most frequent terms are
    counted against each other in a matrix of each task; buckets of the other
    terms add up what the tasks send of all their partners and keep the best, and
    what a frequent term's best may be among them. The buckets come in rounds,
    and a round's shuffle is removed before the next one. There are as many
    buckets as the counted pairs need, and fewer than 2^32 terms.
    """
    spark = df.sparkSession
    lists = df.select(F.array_distinct(_tokens(text, stopwords)).alias("terms")).where(F.size("terms") > 1)
    with shuffles_removed(spark):
        coded = written(lists.mapInArrow(pairs.coded, pairs.CODED_DDL), "coded")
        held = coded.select("_chunk", F.posexplode(F.arrays_zip("terms", "counts")).alias("code", "t")).select(F.col("_chunk").alias("_chunk"), "code", F.col("t.terms").alias("term"), F.col("t.counts").alias("n"))
        frequency = held.groupBy("term").agg(F.sum("n").alias("df"))
        numbered = written(number_rows(frequency, "term", name="no"), "terms")
        # At most MATRIX_A_HEAD * ``head`` rows.
        often = numbered.orderBy(F.desc("df"), "no").limit(pairs.MATRIX_A_HEAD * head).select(F.col("no").alias("a"), F.col("term").alias("term_a"))
        heads = np.array(sorted(r["a"] for r in often.select("a").collect()), np.uint64)
        answers = held.join(numbered, "term").select("_chunk", "code", "no")
        chunk = coded.select("_chunk", "tokens", "sets", "codes", "sizes").groupBy("_chunk")
        sets = written(chunk.cogroup(answers.groupBy("_chunk")).applyInArrow(pairs.numbered(heads), pairs.NUMBERED_DDL), "numbered")
        removed(coded)
        size = sets.agg(F.sum("tokens").alias("tokens"), F.sum("pairs").alias("pairs")).first()
        buckets = max(1, -(-(size["pairs"] or 0) // pairs.PAIRS_IN_BUCKET))
        rounds = max(1, min(-(-(size["pairs"] or 0) // (pairs.PAIRS_A_ROUND * (size["tokens"] or 1))), buckets // spark.sparkContext.defaultParallelism))
        splits = sets.rdd.getNumPartitions()
        few = sets.coalesce(max(1, min(splits, max(spark.sparkContext.defaultParallelism, -(-splits // pairs.SPLITS_A_TASK)))))
        among = few.mapInArrow(pairs.head_counts(heads), pairs.PART_DDL).groupBy("part").applyInArrow(pairs.best_of_heads(n, heads), pairs.HEADS_DDL)
        among = written(among, "head-partners")
        # One row for each head at most; one with fewer partners in the matrix takes any other.
        full = {r["a"]: r["n"] for r in among.where(F.col("rank") == n).collect()}
        least = np.array([full.get(int(h), 0) for h in heads], np.int64)
        best = None
        for number in range(rounds):
            dealt = sets.mapInArrow(pairs.sent(buckets, buckets * number // rounds, buckets * (number + 1) // rounds, heads), pairs.SENT_DDL)
            found = written(dealt.groupBy("bucket").applyInArrow(pairs.best_of_bucket(n, heads, least), pairs.BEST_DDL), "partners")
            best = found if best is None else best.unionAll(found)
        removed(sets)
        others = best.select(F.explode(F.arrays_zip("head", "partner", "common")).alias("t")).select(F.col("t.head").alias("a"), F.col("t.partner").alias("b"), F.col("t.common").alias("n"))
        others = written(others, "head-partners")
    best = best.drop("head", "partner", "common")
    names = best.mapInArrow(pairs.asked, "bucket long, no long").join(numbered.select("no", "term"), "no")
    rest = best.groupBy("bucket").cogroup(names.groupBy("bucket")).applyInArrow(pairs.named, pairs.NAMED_DDL)
    # At most ``n`` rows for each head.
    again = top_per_group(among.drop("rank").unionByName(others), ["a"], [F.desc("n"), F.asc("b")], n)
    again = F.broadcast(again).join(numbered.select(F.col("no").alias("b"), F.col("term").alias("term_b")), "b").join(F.broadcast(often), "a")
    return rest.unionByName(again.select("term_a", "term_b", "n", "rank"))


# Entries of a matrix of counts that are held at once, and entries of the question vectors in one block of them.
MATRIX_ENTRIES = 1 << 21
QUESTION_ENTRIES = 200_000


def _products(left: pa.Table, right: pa.Table, left_key: str, right_key: str, least: float, schema: pa.Schema) -> pa.Table:
    """The products of a chunk of texts with a block of questions, where the cosine may reach ``least``."""
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    ids, asked = chunks.whole(left.column(left_key)).dictionary_encode(), chunks.whole(right.column(right_key)).dictionary_encode()
    own = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    codes, bounds, words = chunks.coded(left.column("_tokens"))
    cells, tf = np.unique(np.repeat(own, np.diff(bounds)) * max(1, len(words)) + codes, return_counts=True)
    texts, codes = cells // max(1, len(words)), cells % max(1, len(words))
    aa = np.bincount(texts, weights=tf * tf, minlength=len(ids.dictionary))
    known = chunks.whole(right.column("term")).dictionary_encode()
    place = np.append(pc.fill_null(pc.index_in(words, value_set=known.dictionary), -1).to_numpy(zero_copy_only=False), -1)[codes]
    texts, place, tf = texts[place >= 0], place[place >= 0], tf[place >= 0]
    term, item = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (known, asked))
    tf_b, size, questions = right.column("tf_b").to_numpy(), len(known.dictionary), len(asked.dictionary)
    bb = np.zeros(questions)
    bb[item] = right.column("sq_b").to_numpy()
    step = max(1, MATRIX_ENTRIES // size)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low in range(0, questions, step):
        mine = (item >= low) & (item < low + step)
        counts = np.zeros((size, min(step, questions - low)))
        counts[term[mine], item[mine] - low] = tf_b[mine]
        for first in range(0, len(aa), step):
            begin, end = np.searchsorted(texts, [first, first + step])
            block = np.zeros((min(step, len(aa) - first), size))
            block[texts[begin:end] - first, place[begin:end]] = tf[begin:end]
            ab = block @ counts
            # Spark rounds and decides; this only holds back what is far below.
            length = np.sqrt(aa[first:first + step, None] * bb[None, low:low + step])
            a, b = np.nonzero((ab > 0) & (ab >= (least - 1e-5) * length))
            found.append((a + first, b + low, ab[a, b]))
    a, b, ab = (np.concatenate(c) for c in zip(*found))
    columns = [ids.dictionary.take(pa.array(a)), asked.dictionary.take(pa.array(b)), *(pa.array(c.astype(np.int64)) for c in (ab, aa[a], bb[b]))]
    return pa.table(columns, schema=schema)


def count_vector_cosine(left: DataFrame, right: DataFrame, left_key: str, right_key: str, text: str, least: float = 0.8) -> DataFrame:
    """Pairs of ``left`` and ``right`` texts whose term-count vectors have a cosine of ``least`` or more.

    ``right`` is a set of questions put to the texts of ``left``. Texts lie in
    chunks and questions in blocks, both of bounded size; a chunk and a block
    are multiplied as matrices, and only pairs near ``least`` leave the task.
    Texts without a term or without an id have no partner.
    """
    squares = F.sum(F.col("tf") * F.col("tf")).over(Window.partitionBy(right_key))
    asked = term_counts(right.where(F.col(right_key).isNotNull()), right_key, text).select(
        right_key, "term", F.col("tf").alias("tf_b"), squares.alias("sq_b"))
    asked = written(asked, "questions")
    blocks = max(1, -(-asked.count() // QUESTION_ENTRIES))
    texts = chunks.in_chunks_by_id(left.where(F.col(left_key).isNotNull()), left_key, text, _tokens(text, ()))
    numbers = texts.select("_chunk").distinct().select(F.col("_chunk").alias("_chunk"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    every = asked.withColumn("_block", F.pmod(F.xxhash64(right_key), F.lit(blocks)).cast("int")).join(numbers, "_block")
    spread = texts.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    kinds = StructType([texts.schema[left_key], asked.schema[right_key], *(StructField(n, LongType()) for n in ("ab", "aa", "bb"))])
    schema = to_arrow_schema(kinds)

    def multiplied(a: pa.Table, b: pa.Table) -> pa.Table:
        return _products(a, b, left_key, right_key, least, schema)

    cell = ["_chunk", "_block"]
    dots = spread.groupBy(*cell).cogroup(every.groupBy(*cell)).applyInArrow(multiplied, kinds)
    length = F.sqrt(F.col("aa").cast("double") * F.col("bb"))
    return dots.select(left_key, right_key, F.round(F.col("ab") / length, 6).alias("cosine")).where(F.col("cosine") >= least)


def keyword_extract(df: DataFrame, key: str, text: str, group: str, terms: Sequence[str], n: int = 20) -> DataFrame:
    """Key terms of the texts that match ``terms``, per group, by TF-IDF."""
    return tfidf_top_n(df.where(F.col(text).rlike("|".join(terms))), key, text, group, n=n)


# Longest left part of a token that is looked at, and tokens that may be cut; a longer token is whole.
MAX_STEM = 20


def token_stems(df: DataFrame, text: str) -> DataFrame:
    """Each token of the texts with the left part that holds together best: token, stem, n.

    The cohesion of the first k letters of a token is (f(k) / f(1)) ^ (1 / (k - 1)),
    f(k) being the occurrences of all tokens that begin with them. It falls
    where many endings follow, so particles are cut where the corpus shows the
    stem with several of them. The left part of 2 letters or more with the
    highest cohesion, rounded to 6, is the stem; of equal ones the longest.
    Tokens beyond MAX_STEM letters are whole.
    """
    counts = df.select(F.explode(tx.tokens_of(F.col(text))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "tokens")
    short = counts.where(F.length("token") <= MAX_STEM)
    parts = short.select("token", "n", F.explode(F.sequence(F.lit(1), F.length("token"))).alias("k")).withColumn("part", F.expr("left(token, k)"))
    held = written(parts.groupBy("part", "k").agg(F.sum("n").alias("f"), F.count(F.lit(1)).alias("rows")), "left-parts")
    # One row per letter that begins a token.
    firsts = held.where("k = 1").select(F.col("part").alias("_first"), F.col("f").alias("f1"))
    longer = hot_key_join(parts.where("k > 1").drop("k"), held.where("k > 1"), ["part"], "rows", spread_by="token")
    scored = longer.withColumn("_first", F.left("token", F.lit(1))).join(F.broadcast(firsts), "_first")
    cohesion = F.round(F.pow(F.col("f") / F.col("f1"), 1.0 / (F.col("k") - 1)), 6)
    best = scored.groupBy("token", "n").agg(F.min(F.struct((-cohesion).alias("c"), (-F.col("k")).alias("k"), "part"))["part"].alias("stem"))
    whole = counts.where(F.length("token") > MAX_STEM).select("token", "n", F.col("token").alias("stem"))
    return best.select("token", "stem", "n").unionByName(whole.select("token", "stem", "n"))


def stemmed_nouns(df: DataFrame, key: str, text: str, stems: DataFrame, stopwords: Sequence[str] = ()) -> DataFrame:
    """The stems of a text's tokens in their order, without stopwords: key, nouns. Ids are unique; a text without tokens gives ''.

    Texts lie in chunks that ask for the stem of each of their tokens once.
    """
    texts = chunks.in_chunks_by_id(df, key, text, tx.tokens_of(F.col(text)))
    answers = chunks.chunk_terms(texts, "_tokens").join(stems.select(F.col("token").alias("term"), "stem"), "term").select("_chunk", "term", "stem")
    kinds = StructType([texts.schema[key], StructField("nouns", StringType())])
    schema = to_arrow_schema(kinds)
    stop = pa.array(list(stopwords), pa.string())

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        at, bounds = chunks.places(left.column("_tokens"), right.column("term"))
        found = chunks.whole(right.column("stem"))
        kept = (~pc.is_in(found, value_set=stop).to_numpy(zero_copy_only=False).astype(bool))
        keep = np.append(kept, False)[at]
        ends = np.concatenate([[0], np.cumsum(keep)])[bounds]
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), found.take(pa.array(at[keep])))
        return pa.table([chunks.whole(left.column(key)), pc.binary_join(lists, " ")], schema=schema)

    return texts.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(joined, kinds)
