"""A corpus pipeline of five operators.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that its caller writes as Parquet and reads again for the
next.  All but the last return the columns of documents, whatever these are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import line_dedup, mixing, ngram_join, packing, toxicity
from gridloom.llm.common import doc_fold, shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel classifier, trained on the labels outside the held-out fold, does not reject.

    A null or empty text stays as it is, and so do rows that repeat a doc_id, each judged by its own text; rows without
    doc_id are judged and never trained on; without labels of both kinds nothing is rejected; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, doc_fold(5) != 0)
    return toxicity.score(docs, model, "__gl_score").where(F.col("__gl_score") < 0.5).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with ``text`` (and ``n_chars``, if there) less the lines that three or more documents repeat.

    A null text becomes the empty one; rows that repeat a doc_id count as one document; a row without doc_id loses nothing.
    """
    done = line_dedup.drop_repeated_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return done.select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8 or more.

    Texts without words stay; rows that agree in doc_id and text are one; of a group the least doc_id stays, null last.
    """
    return ngram_join.one_of_each_group(docs, n=5, threshold=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    A document without words is taken no time; a null source is a source of its own, the last one; repeated rows are
    documents of their own; an empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048.

    A null or empty text is one piece of the end id alone; repeated rows are packed each for itself; an empty table gives
    no piece.
    """
    import public_tokenizers

    return packing.digest(*packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The stages train a model, tokenize and search, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
