"""URL verdicts: host and path rules, else a logistic regression.

The model works on hashed character n-grams of host and path and is fitted
on a small labelled table.  Everything is DataFrame expressions and MLlib:
n-grams are array expressions, the hashing and the model run in the JVM.

Null urls and urls without ``://`` have an empty host and path; they are
judged by the model like any other.  Repeated rows are judged one by one.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: (verdict, rule as host/path) of the registered query
RULES = (
    (ALLOW, "com/"), (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"),
)
NGRAMS = (3, 4, 5)
N_FEATURES = 1 << 15
REG_PARAM = 0.01
MAX_ITER = 60
THRESHOLD = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Labelled words of the small training table; hosts and paths are made of
# them by rule, with the same frames for both labels.
BLOCK_WORDS = """
adult sex porn xxx erotic escort nude casino poker betting gambling jackpot
slots viagra pharma pills cheapmeds replica warez crack keygen torrent spam
linkfarm spamfarm clickbait malware phishing scam freemoney payday ads track
""".split()
ALLOW_WORDS = """
news blog library school science travel garden recipe museum weather history
music sports health market council journal review archive forum gallery
studio history language physics cooking cycling hiking painting reading
thorin ondere leaux ention schver ciones verein rathaus mairie ayuntamiento
""".split()
#: site names that are no words: pairs and triples of frequent syllables
SYLLABLES = "the an er in re on ti es or te st ed is it al ar ha to nt en".split()
NAMES = [a + b for i, a in enumerate(SYLLABLES)
         for b in (SYLLABLES[(i + 3) % 20], SYLLABLES[(i + 7) % 20],
                   SYLLABLES[(i + 11) % 20] + SYLLABLES[(i + 1) % 20])]
FRAMES = (
    "https://{w}.example.com/en/12", "http://www.{w}.example.org/de/7.html",
    "https://blog.{w}.example.net/en/300/", "http://m.{w}.example.org/fr/45",
    "https://{w}-x.example.net/es/9?page=2", "http://{w}-farm.example.org/",
    "https://www.site.example.org/{w}/index.html",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked): every frame with every word."""
    def rows(words: list[str], blocked: int) -> Column:
        return F.array(*[F.struct(F.lit(f.format(w=w)).alias("url"),
                                  F.lit(blocked).alias("blocked"))
                         for w in words for f in FRAMES])

    both = F.concat(rows(BLOCK_WORDS, 1), rows(ALLOW_WORDS + NAMES, 0))
    return spark.range(1).select(F.inline(both))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def host_of(url: str = "url") -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit(""))


def path_of(url: str = "url") -> Column:
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def matching_rule(rules, host: str = "host", path: str = "path"
                  ) -> tuple[Column, Column]:
    """(longest rule that fits, its verdict); null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = (((F.col(host) == h) | F.col(host).endswith("." + h))
                & F.col(path).startswith("/" + p))
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _grams(text: Column, mark: str, n: int) -> Column:
    last = F.length(text) - (n - 1)
    return F.when(last >= 1, F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
    ).otherwise(F.array().cast("array<string>"))


def url_features(host: str = "host", path: str = "path") -> Column:
    """Marked character n-grams of ``^host$`` and ``^path$``."""
    parts = []
    for col, mark in ((host, "h"), (path, "p")):
        text = F.concat(F.lit("^"), F.lower(col), F.lit("$"))
        parts += [_grams(text, mark, n) for n in NGRAMS]
    return F.concat(*parts)


def fit_filter(labelled: DataFrame):
    """Model of (url, blocked 0/1); both labels must occur.

    The labelled table is small (hundreds of rows), so it is one partition:
    an iteration of the solver is one short task."""
    rows = labelled.select(host_of().alias("host"), path_of().alias("path"),
                           F.col("blocked").cast("double").alias("label"))
    n, n_block = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    # both labels weigh the same
    rows = rows.withColumn("grams", url_features()).withColumn(
        "weight", F.when(F.col("label") > 0, F.lit(n / (2 * n_block)))
        .otherwise(F.lit(n / (2 * (n - n_block))))).coalesce(1)
    return Pipeline(stages=[
        HashingTF(inputCol="grams", outputCol="features", binary=True,
                  numFeatures=N_FEATURES),
        LogisticRegression(regParam=REG_PARAM, maxIter=MAX_ITER,
                           standardization=False, weightCol="weight"),
    ]).fit(rows)


def judge(pages: DataFrame, model, rules=RULES, url_col: str = "url",
          key_cols: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Key columns, ``host, path, rule, verdict`` and ``p_block``."""
    rows = pages.select(*key_cols, F.col(url_col).alias("_url")).withColumns(
        {"host": host_of("_url"), "path": path_of("_url")}).withColumn(
        "grams", url_features())
    scored = model.transform(rows).withColumn(
        "p_block", vector_to_array("probability")[1])
    rule, verdict = matching_rule(rules)
    by_model = F.when(F.col("p_block") > THRESHOLD, BLOCK).otherwise(ALLOW)
    return scored.select(*key_cols, "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, by_model).alias("verdict"),
                         "p_block")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    pages = documents(spark, sf_dir, "pages")
    return judge(pages, fit_filter(labelled_urls(spark)))
