"""Raw texts to the sentence table: clean, split, filter, class, sentiment, nouns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions import text as tx
from pulsegrain.functions import values as vl
from pulsegrain.operators import models, reshape, rows
from pulsegrain.session import written


def clean_sentences(
    df: DataFrame, text: str, stopwords: Sequence[str], keep: str, split_first: bool = True,
) -> DataFrame:
    """One row per cleaned, normalised, non-empty sentence.

    Cleaning drops the punctuation that the splitter needs, so splitting goes
    first by default.
    """

    def cleaned(t: Column) -> Column:
        return tx.normalize_entities(tx.clean_text(t, stopwords, keep))

    if split_first:
        return rows.drop_blank(reshape.explode_sentences(df, text, each=cleaned), "sentence")
    return reshape.explode_sentences(df.withColumn(text, cleaned(F.col(text))), text)


def comment_enrich(
    comments: DataFrame, text: str, classes: Mapping[str, Sequence[str]], positive: Sequence[str], negative: Sequence[str],
    stopwords: Sequence[str] = tuple(lexicons.COMMENT_STOPWORDS), keep: str = lexicons.KEPT_CHARACTERS, split_first: bool = True,
    same: Sequence[str] = (), survivor: Sequence[Column] = (),
) -> DataFrame:
    """Comments to classified, scored sentences; sentences without a class term are dropped.

    Every other column (id, time, likes) goes with its sentences. Comments are
    copies when all their columns are equal, or those in ``same``; of copies
    the first in the order ``survivor`` stays.
    """
    df = rows.drop_blank(rows.drop_latin_only(comments, text), text)
    df = rows.dedup_subset(df, same, survivor) if same else rows.dedup_rows(df)
    df = clean_sentences(df, text, stopwords, keep, split_first)
    df = rows.keep_any_keyword(df, "sentence", [t for terms in classes.values() for t in terms])
    label, score = models.lexicon_sentiment(F.col("sentence"), positive, negative)
    return df.withColumns({
        "brand": models.lexicon_class(F.col("sentence"), classes), "sentiment_label": label, "sentiment_score": score,
    })


def without_words(df: DataFrame, text: str, words: DataFrame) -> DataFrame:
    """Rows whose space-separated words in ``text`` lose those in column ``word`` of a table of any size.

    Words meet the table in an anti-join and find back to their row by its
    number in the stored table, so rows may repeat. A text that loses all its words is ''.
    """
    placed = written(df.withColumn("_at", F.monotonically_increasing_id()), "rows")
    parts = placed.select("_at", F.posexplode(F.split(text, " ")).alias("_pos", "_word"))
    kept = parts.join(words.select(F.col("word").alias("_word")), "_word", "left_anti")
    # The words of one text.
    joined = kept.groupBy("_at").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_word"))), lambda e: e["_word"]), " ").alias("_kept"))
    found = placed.join(joined, "_at", "left").withColumn(text, F.coalesce("_kept", F.lit("")))
    return found.select(*df.columns)


def _cleaned_sentences(df: DataFrame, text: str, stopwords: Sequence[str] | DataFrame, keep: str) -> DataFrame:
    """``clean_sentences`` with the stop words as a list or as a table."""
    if not isinstance(stopwords, DataFrame):
        return clean_sentences(df, text, stopwords, keep)
    split = reshape.explode_sentences(df, text, each=lambda t: tx.clean_text(t, (), keep))
    bare = without_words(split, "sentence", stopwords)
    return rows.drop_blank(bare.withColumn("sentence", tx.normalize_entities(F.col("sentence"))), "sentence")


def review_enrich(
    reviews: DataFrame, item: str, text: str, rating: str, brands: Sequence[tuple[str, str]], brand_ids: Mapping[str, int],
    terms: Sequence[str], positive: Sequence[str], negative: Sequence[str], stopwords: Sequence[str] | DataFrame = (),
    keep: str = lexicons.KEPT_CHARACTERS,
) -> DataFrame:
    """Reviews to scored sentences with nouns, brand id and rating.

    The brand is read from the item name by containment; an unknown brand is
    NULL. Stop words come as a list or as a table with column ``word``, whose size does not matter.
    """
    df = rows.drop_blank(rows.drop_nulls(reviews, [text]), text)
    df = _cleaned_sentences(df, text, stopwords, keep)
    df = rows.keep_any_keyword(df, "sentence", terms)
    label, score = models.lexicon_sentiment(F.col("sentence"), positive, negative)
    brand = vl.category_of(F.col(item), brands)
    carried = [c for c in df.columns if c not in (item, rating, "sentence")]
    return df.select(
        *carried,
        F.col("sentence").alias("cleaned_content"),
        tx.noun_tokens(F.col("sentence")).alias("nouns"),
        vl.mapped(brand, brand_ids, F.lit(None)).cast("int").alias("brand_id"),
        label.alias("sentiment_label"),
        score.alias("sentiment_score"),
        vl.number_or(F.col(rating).cast("string"), "int").alias("rating"),
    )
