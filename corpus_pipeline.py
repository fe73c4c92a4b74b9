"""From raw documents to token ids: toxicity, language, near duplicates, mixing, BPE.

Each stage works on all that the one before has kept. The first three drop documents,
the fourth repeats and cuts them to the sources' weights, the last turns texts into
token ids. Stages before the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegraph.llm import bpe, langid, mixing, neardup, toxicity
from pagegraph.llm.common import documents, fold, free_name
from pagegraph.session import staged

#: A document stays if its language is told with this probability or more.
LANGUAGE_SCORE = 0.5


# In every stage repeated rows count each (of near copies one stays), other columns pass as
# they are whatever their names, an empty table gives an empty one, and of a long text every word
# counts. What each does with nulls and empty texts is said below.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones of four folds, scores under 0.5.

    A null or empty text has no features and gets the score that stands without any. A null id is
    never labelled. Without labels of both kinds all documents have one score.
    """
    return toxicity.keep_clean(docs, toxicity.train_on(docs, sf_dir))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model, learned from three folds, can tell.

    A text that is null or has no letter goes. Rows without language teach nothing; where none has
    one, all go.
    """
    model = langid.train(docs.filter(fold("doc_id", langid.FOLDS) != langid.HELD_OUT))
    return langid.keep_known(docs, model, LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the SimHash operator links: 3-word shingles, 2 bits.

    The one with the least id stays, a null id last, ties by a hash of the row. Texts without
    words, null ones too, are one group.
    """
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; the one at a source's cut up to it.

    A null source is one of its own. Texts without words are taken by no source. A text that is
    cut has its ``n_chars`` anew.
    """
    size = free_name(docs.columns, "size")
    sized = docs.withColumn(size, mixing.word_count(F.col("text")))
    mixed = mixing.mix(sized, size, tie=F.xxhash64("text"))
    return mixing.repeated(mixed, "text", size, docs.columns, "n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the token ids in place of the text; of a null or empty text none."""
    return bpe.encode(docs).withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Learned models, fingerprints' components and token ids are beyond SQL; tests hold each stage
#: against a brute-force version of its rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
