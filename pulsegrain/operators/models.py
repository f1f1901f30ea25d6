"""Labels, scores and samples of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from pulsegrain.functions import text as tx
from pulsegrain.functions import values as vl
from pulsegrain.operators import chunks
from pulsegrain.operators.numbering import number_rows
from pulsegrain.session import written

# Copies of one row that are made in one go.
COPY_BLOCK = 10_000


# -- sentiment and class by word lists

def lexicon_sentiment(text: Column, positive: Sequence[str], negative: Sequence[str]) -> tuple[Column, Column]:
    """Label ('1', '0' or NULL) and confidence from counts of listed terms."""
    p, n = vl.occurrence_total(text, positive), vl.occurrence_total(text, negative)
    label = F.when(p > n, F.lit("1")).when(p < n, F.lit("0"))
    return label, F.round(F.try_divide(F.abs(p - n).cast("double"), p + n), 6)


def learn_lexicon(df: DataFrame, text: str, label: str) -> DataFrame:
    """Signed word weights from labelled texts: term, units, n.

    A weight is the log odds of a term between texts of label 1 and of label 0,
    every term of the vocabulary counted once more, in millionths. Rows with
    another label or none teach nothing.
    """
    known = df.where(F.col(label).isin(0, 1)).select(F.col(label).alias("_y"), F.explode(tx.tokens_of(F.col(text))).alias("term"))
    positive = F.col("_y") == 1
    counts = written(known.groupBy("term").agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("m")), "lexicon-counts")
    whole = counts.agg(F.struct(F.coalesce(F.sum("p"), F.lit(0)).alias("p"), F.coalesce(F.sum("m"), F.lit(0)).alias("m"), F.count(F.lit(1)).alias("v"))).scalar()
    odds = F.log((F.col("p") + 1.0) / (F.col("_w.p") + F.col("_w.v"))) - F.log((F.col("m") + 1.0) / (F.col("_w.m") + F.col("_w.v")))
    return counts.withColumn("_w", whole).select("term", F.round(odds * 1_000_000).cast("long").alias("units"), (F.col("p") + F.col("m")).alias("n"))


def weighted_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame, negations: Sequence[str], window: int = 2) -> DataFrame:
    """Label ('1', '0' or NULL) and confidence of each text by a table of signed word weights: key, label, score.

    A word after a negation, ``window`` words at most, counts the other way
    round. The label is the sign of the summed weights, the score their share of
    all weight met. Weights are whole numbers, so sums do not depend on their
    order. Texts lie in chunks that ask for each of their words once. Ids are
    unique; a text without a known word has neither.
    """
    texts = chunks.in_chunks_by_id(df, key, text, tx.tokens_of(F.col(text)))
    answers = chunks.chunk_terms(texts, "_tokens").join(lexicon.select("term", "units"), "term").select("_chunk", "term", "units")
    kinds = StructType([texts.schema[key], StructField("s", LongType()), StructField("w", LongType())])
    schema = to_arrow_schema(kinds)
    no = pa.array(list(negations), pa.string())

    def weighed(left: pa.Table, right: pa.Table) -> pa.Table:
        at, bounds = chunks.places(left.column("_tokens"), right.column("term"))
        units = np.append(right.column("units").to_numpy().astype(np.int64), 0)[at]
        negation = pc.is_in(chunks.whole(left.column("_tokens")).flatten(), value_set=no).to_numpy(zero_copy_only=False).astype(bool)
        place = np.arange(len(at)) - np.repeat(bounds[:-1], np.diff(bounds))
        turned = np.zeros(len(at), bool)
        for back in range(1, min(window, len(at) - 1) + 1):
            turned[back:] |= negation[:-back] & (place[back:] >= back)
        sums = [pa.array(chunks.row_sums(v, bounds)) for v in (np.where(turned, -units, units), np.abs(units))]
        return pa.table([chunks.whole(left.column(key)), *sums], schema=schema)

    found = texts.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(weighed, kinds)
    label = F.when(F.col("s") > 0, "1").when(F.col("s") < 0, "0")
    return found.select(key, label.alias("label"), F.round(F.try_divide(F.abs("s").cast("double"), F.col("w")), 6).alias("score"))


def lexicon_class(text: Column, classes: Mapping[str, Sequence[str]], none: str = "none") -> Column:
    """The class whose terms occur most; the earlier one on a tie; ``none`` without any hit."""
    counts = {name: vl.occurrence_total(text, terms) for name, terms in classes.items()}
    top = F.greatest(*counts.values()) if len(counts) > 1 else next(iter(counts.values()))
    label = F.when(top <= 0, F.lit(none))
    for name, count in counts.items():
        label = label.when(count == top, F.lit(name))
    return label


# -- any model over Arrow batches

def scored_by_model(
    df: DataFrame, text: str, load: Callable[[], Callable[[Sequence[str]], Sequence[tuple[str, float]]]],
    batch: int = 32,
) -> DataFrame:
    """Add ``label`` and ``score`` from a model.

    ``load`` runs once per task and returns a function from texts to
    (label, score) pairs, called with ``batch`` whole texts at a time.
    """

    @F.pandas_udf("label string, score double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for part in parts:
            texts = [("" if t is None else t) for t in part]
            pairs = [pair for i in range(0, len(texts), batch) for pair in model(texts[i:i + batch])]
            yield pd.DataFrame(pairs, columns=["label", "score"])

    scored = df.withColumn("_scored", score(F.col(text)))
    return scored.select(*df.columns, "_scored.label", "_scored.score")


def mapped_text(text: Column, fn: Callable[[str], str]) -> Column:
    """A per-text Python function, run on Arrow batches."""

    @F.pandas_udf("string")
    def apply(part: pd.Series) -> pd.Series:
        return part.map(lambda t: None if t is None else fn(t))

    return apply(text)


# -- trained classifier

def train_text_classifier(
    df: DataFrame, text: str, label: str, features: int = 1 << 14, iterations: int = 20, key: str | None = None, most: int = 50_000,
) -> PipelineModel:
    """Word-count TF-IDF features and a multinomial logistic regression.

    At most ``most`` labelled rows teach it, drawn by ``key``; without a key all
    do. Their hashed counts are stored once, and all steps are fitted on those.
    Rows without a label teach nothing; a null text counts as empty.
    """
    known = df.where(F.col(label).isNotNull())
    if key is not None:
        known = known.join(sample_rows(known.select(key).where(F.col(key).isNotNull()).distinct(), key, most), key, "left_semi")
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False)
    counts = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features)
    texts = known.select(F.coalesce(text, F.lit("")).alias("_text"), F.col(label).alias("_label"))
    hashed = written(counts.transform(words.transform(texts)).select("_label", "_tf"), "features")
    index = StringIndexer(inputCol="_label", outputCol="_y", stringOrderType="alphabetAsc").fit(hashed)
    weights = IDF(inputCol="_tf", outputCol="_features").fit(hashed)
    taught = weights.transform(index.transform(hashed))
    machine = LogisticRegression(featuresCol="_features", labelCol="_y", predictionCol="_p", maxIter=iterations, regParam=0.01).fit(taught)
    given = SQLTransformer(statement=f"SELECT *, coalesce(`{text}`, '') AS _text FROM __THIS__")
    return PipelineModel([given, words, counts, weights, machine, IndexToString(inputCol="_p", outputCol="predicted", labels=index.labels)])


# -- naive Bayes from count tables

def fold_of(key: Column) -> Column:
    """The fold of a row, one of 16, by its id alone: the first hexadecimal digit of the id's MD5."""
    return F.left(F.md5(key.cast("string").cast("binary")), F.lit(1))


def bayes_model(df: DataFrame, key: str, text: str, label: str) -> tuple[DataFrame, DataFrame]:
    """A multinomial naive Bayes model as two tables, counted from the rows that have a label.

    Terms: term, df (rows that hold it) and weights, a map from class to
    ln(1 + occurrences) for the classes that have the term. Classes: class,
    prior (log share of the rows) and scale, ln of the class's occurrences plus
    the vocabulary; every term counts once more than it occurs. A null text has no terms.
    """
    known = df.where(F.col(label).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(label).alias("class"))
    counts = known.select("class", F.explode(tx.tokens_of(F.col("_text"))).alias("term")).groupBy("class", "term").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "class-terms")
    # One entry per class.
    terms = counts.groupBy("term").agg(
        F.map_from_entries(F.collect_list(F.struct("class", F.log(F.col("n") + 1.0)))).alias("weights"), F.sum("n").alias("df"))
    size = terms.agg(F.count(F.lit(1))).scalar()
    rows = known.groupBy("class").agg(F.count(F.lit(1)).alias("rows"))
    totals = rows.join(counts.groupBy("class").agg(F.sum("n").alias("n")), "class", "left")
    classes = totals.select(
        "class", F.log(F.col("rows") / F.sum("rows").over(Window.partitionBy())).alias("prior"),
        F.log(F.coalesce("n", F.lit(0)) + size.cast("double")).alias("scale"))
    return written(terms, "bayes-terms"), written(classes, "bayes-classes")


def bayes_classify(df: DataFrame, key: str, text: str, terms: DataFrame, classes: DataFrame) -> DataFrame:
    """The most likely class of each row: key, predicted, score (log likelihood, rounded to 6).

    Terms that the model has not seen tell nothing. Texts lie in chunks by id
    that ask for the weights of each of their terms once; ties go to the first class by
    name, and a text without a known term gets the most frequent class. Rows that repeat an id are one text.
    """
    texts = chunks.in_chunks_by_id(df, key, text, tx.tokens_of(F.col(text)))
    weights = terms.select("term", F.explode("weights").alias("class", "w"))
    answers = chunks.chunk_terms(texts, "_tokens").join(weights, "term").select("_chunk", "term", "class", "w")
    kinds = StructType([texts.schema[key], StructField("known", LongType()), StructField("names", ArrayType(weights.schema["class"].dataType)),
                        StructField("sums", ArrayType(DoubleType()))])
    schema = to_arrow_schema(kinds)

    def weighed(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = chunks.whole(left.column(key))
        ids, first = chunks.cells_of([keys])
        term = chunks.whole(right.column("term")).dictionary_encode()
        at, bounds = chunks.places(left.column("_tokens"), term.dictionary)
        rows, at = np.repeat(ids, np.diff(bounds))[at >= 0], at[at >= 0]
        code, w = term.indices.to_numpy(zero_copy_only=False), right.column("w").to_numpy()
        names = chunks.whole(right.column("class")).dictionary_encode()
        of = names.indices.to_numpy(zero_copy_only=False)
        sums = np.zeros((len(first), len(names.dictionary)))
        for i in range(len(names.dictionary)):
            mine = np.zeros(len(term.dictionary))
            mine[code[of == i]] = w[of == i]
            sums[:, i] = np.bincount(rows, weights=mine[at], minlength=len(first))
        ends = pa.array(np.arange(len(first) + 1) * len(names.dictionary), pa.int32())
        every = pa.array(np.tile(np.arange(len(names.dictionary)), len(first)))
        columns = [keys.take(pa.array(first)), pa.array(np.bincount(rows, minlength=len(first))),
                   pa.ListArray.from_arrays(ends, names.dictionary.take(every)), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    found = texts.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(weighed, kinds)
    # A few classes.
    told = found.withColumn("_classes", classes.agg(F.collect_list(F.struct("class", "prior", "scale"))).scalar()).withColumn("_sums", F.map_from_arrays("names", "sums"))

    def scored(c: Column) -> Column:
        score = c["prior"] + F.coalesce(F.element_at("_sums", c["class"]), F.lit(0.0)) - F.col("known") * c["scale"]
        return F.struct((-F.round(score, 6)).alias("s"), c["class"].alias("class"))

    best = told.select(key, F.array_min(F.transform("_classes", scored)).alias("b"))
    return best.select(key, F.col("b.class").alias("predicted"), (-F.col("b.s")).alias("score"))


def save_classifier(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def classify_text(df: DataFrame, model: PipelineModel, name: str = "predicted") -> DataFrame:
    """Add the predicted class; every model step runs inside Spark."""
    return model.transform(df).select(*df.columns, F.col("predicted").alias(name))


# -- samples

def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows at random: those with the smallest seeded hash of the key."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")).cast("binary"))
    return df.orderBy(draw, key).limit(n)


def oversample_classes(df: DataFrame, label: str, key: str) -> DataFrame:
    """Copies of rows so that every class is as large as the largest.

    Rows of a class are repeated in turn in key order, which is the even form
    of drawing with replacement.
    """
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    largest = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    numbered = number_rows(df, key, groups=[label], name="_no").join(sizes, label).withColumn("_largest", largest)
    counted = numbered.withColumn("_copies", F.floor((F.col("_largest") - F.col("_no")) / F.col("_size")) + 1)
    # The only row of a class may need as many copies as the largest class has
    # rows: they are made block by block, and the blocks are spread over tasks.
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_BLOCK))))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("_block") * COPY_BLOCK + 1
    last = F.least(F.col("_copies"), first + (COPY_BLOCK - 1))
    return blocks.repartition(tasks, key, "_block").withColumn("copy_no", F.explode(F.sequence(first.cast("int"), last.cast("int")))) \
        .select(*df.columns, "copy_no")
