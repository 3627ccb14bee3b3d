"""Text features: tokens, stop words, vocabulary, term counts, IDF, TF-IDF.

Two forms of the same semantics:

* DataFrame jobs (``tokenize`` ... ``tf_idf``) that produce tables in long
  form -- one row per (document, term).  Postings and vocabulary are hash
  aggregations, pre-aggregated per task, in generated code (counting a sorted
  array with lambdas needs no shuffle but runs interpreted, several times
  slower).  In the joins with the vocabulary the postings of a term are dealt
  over ``SALTS`` reducers and the vocabulary is repeated for each, so a term
  of every document is no hot key.
* ``pyspark.ml`` stages (``*_stage``) for pipelines that need vectors.

Both agree up to ``vocab_size`` terms (no limit in long form unless given):
tokens = ``RegexTokenizer(pattern='\\W+', gaps=True)``, stop
words = ``StopWordsRemover`` (case-insensitive English list), vocabulary =
``CountVectorizer`` (terms in at least ``minDF`` documents, most frequent
first), IDF = ``ln((N + 1) / (df + 1))``.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizer, IDF, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.functions.columns import TOKEN_GAP_PATTERN, drop_stop_words, regex_tokens
from fundscope.functions.stopwords import default_stop_words

DEFAULT_VOCAB_SIZE = 1 << 18        # CountVectorizer default
COUNTERS = 1 << 14                  # of the frequent-items sketch
SALTS = 16                          # reducers that share a term's postings


# ---------------------------------------------------------------- DataFrame jobs

def tokenize(df: DataFrame, input_col: str = "text", output_col: str = "tokens") -> DataFrame:
    return df.withColumn(output_col, regex_tokens(input_col))


def remove_stop_words(df: DataFrame, input_col: str = "tokens", output_col: str = "filtered",
                      stop_words=None, case_sensitive: bool = False) -> DataFrame:
    words = default_stop_words() if stop_words is None else stop_words
    return df.withColumn(output_col, drop_stop_words(input_col, words, case_sensitive))


def explode_positions(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """(id, pos, token): the token stream of each document, 0-based."""
    # ``explode_outer`` + a null test on the output: a plain ``explode`` makes
    # the optimizer add ``size(tokens) > 0`` under the projection, which runs
    # the whole tokenizer a second time for every row.
    return (df.select(id_col, F.posexplode_outer(tokens_col).alias("pos", "token"))
              .filter(F.col("token").isNotNull()))


def term_frequencies(df: DataFrame, id_col: str = "doc_id", tokens_col: str = "filtered") -> DataFrame:
    """(id, term, tf): count of each term in each row; ids are unique.

    Counted by (id, term), summed up in each task before the shuffle: a row's
    tokens come from one task, so every pair is shuffled once.
    """
    tokens = df.select(id_col, F.explode_outer(tokens_col).alias("term")).filter(F.col("term").isNotNull())
    return tokens.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def stored_postings(df: DataFrame, id_col: str = "doc_id", tokens_col: str = "filtered") -> DataFrame:
    """``term_frequencies``, checkpointed: a plan that uses them more than once tokenizes once."""
    from fundscope.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return term_frequencies(df, id_col, tokens_col).checkpoint()


def _min_df_threshold(docs: DataFrame, min_df: float):
    """``minDF`` >= 1 is a document count, below 1 a fraction of documents."""
    if min_df >= 1.0:
        return F.lit(float(min_df))
    return F.lit(float(min_df)) * docs.select(F.count(F.lit(1))).scalar()


def vocabulary(tf: DataFrame, docs: DataFrame, min_df: float = 1.0,
               vocab_size: int | None = None) -> DataFrame:
    """(term, doc_freq, term_count) of terms in >= ``min_df`` documents.

    With ``vocab_size`` only the most frequent terms are kept (ties by term);
    the cut is a top-n (each partition keeps its best ``vocab_size`` rows).
    """
    stats = (tf.groupBy("term")
               .agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("term_count"))
               .filter(F.col("doc_freq") >= _min_df_threshold(docs, min_df)))
    if vocab_size is None:
        return stats
    return stats.orderBy(F.desc("term_count"), F.asc("term")).limit(vocab_size)


def capped_vocabulary(docs: DataFrame, vocab_size: int, min_df: float = 1.0, id_col: str = "doc_id", tokens_col: str = "filtered",
                      counters: int = COUNTERS, tf: DataFrame | None = None) -> DataFrame:
    """(term, doc_freq, term_count) of the ``vocab_size`` most frequent terms (ties by term), without counting all terms.

    A first pass keeps ``counters`` approximate counters in each task (a
    frequent-items sketch) and merges them.  A term that the merged sketch does
    not list occurs at most ``2 * 3.5 / counters`` times the number of tokens;
    a second pass counts the listed terms exactly, so the cut is exact when its
    last term occurs more often than that.  Where it does not (a flat
    distribution, or ``vocab_size`` near ``counters``), all terms are counted.
    At most ``counters`` terms go through the driver.  ``tf``: the postings, if
    they are there already.
    """
    tokens = docs.select(F.explode(tokens_col).alias("term")).where(F.col("term").isNotNull())
    sketch = tokens.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(term, {counters}, {counters})").alias("top")).first()
    listed = docs.sparkSession.createDataFrame([(x["item"],) for x in sketch["top"] or []], "term string")
    tf = term_frequencies(docs, id_col, tokens_col) if tf is None else tf
    exact = vocabulary(restrict_to_vocabulary(tf, listed), docs, min_df, vocab_size).checkpoint()
    least = exact.agg(F.min("term_count").alias("least"), F.count("*").alias("n")).first()
    if least["n"] == vocab_size and least["least"] > 7.0 * sketch["n"] / counters:
        return exact
    return vocabulary(tf, docs, min_df, vocab_size)


def idf_weights(vocab: DataFrame, docs: DataFrame, min_doc_freq: int = 0) -> DataFrame:
    """(term, doc_freq, idf) with idf = ln((N + 1) / (df + 1)); 0 below ``min_doc_freq``."""
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    idf = F.log((n_docs + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))
    return vocab.select("term", "doc_freq", "term_count",
                        F.when(F.col("doc_freq") >= min_doc_freq, idf).otherwise(F.lit(0.0))
                        .alias("idf"))


def salted_join(tf: DataFrame, terms: DataFrame, how: str = "inner") -> DataFrame:
    """Join postings with a table of one row per term, a term's postings dealt over ``SALTS`` reducers."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    dealt = tf.withColumn("_salt", salt)
    repeated = terms.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(repeated, ["term", "_salt"], how).drop("_salt")


def restrict_to_vocabulary(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    """(id, term, tf) for vocabulary terms only."""
    return salted_join(tf, vocab.select("term"), "left_semi").select(tf.columns)


def tf_idf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """(id, term, tf, tfidf) for vocabulary terms."""
    joined = salted_join(tf, idf.select("term", "idf"), "inner")
    return joined.select(*tf.columns, (F.col("tf") * F.col("idf")).alias("tfidf"))


# ---------------------------------------------------------------- ML stages

def tokenizer_stage(input_col: str = "text", output_col: str = "tokens") -> RegexTokenizer:
    return RegexTokenizer(inputCol=input_col, outputCol=output_col,
                          pattern=TOKEN_GAP_PATTERN, gaps=True, toLowercase=True)


def stop_words_stage(input_col: str = "tokens", output_col: str = "filtered") -> StopWordsRemover:
    return StopWordsRemover(inputCol=input_col, outputCol=output_col,
                            stopWords=list(default_stop_words()), caseSensitive=False)


def count_vectorizer_stage(input_col: str = "filtered", output_col: str = "rawFeatures",
                           min_df: float = 1.0, vocab_size: int = DEFAULT_VOCAB_SIZE) -> CountVectorizer:
    return CountVectorizer(inputCol=input_col, outputCol=output_col,
                           minDF=float(min_df), vocabSize=vocab_size)


def idf_stage(input_col: str = "rawFeatures", output_col: str = "tfidf",
              min_doc_freq: int = 0) -> IDF:
    return IDF(inputCol=input_col, outputCol=output_col, minDocFreq=min_doc_freq)
