"""URL filters: rules on host and path first, else logistic regression on hashed character n-grams.

The regression is trained by Spark ML from a small table of labelled URLs and applied with JVM
functions only. Host and path give separate n-grams, so a word means one thing in each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_FEATURES = 1 << 15
SIZES = (3, 4, 5)
REGULARISATION = 0.001
ITERATIONS = 60
THRESHOLD = 0.5
BLOCK, ALLOW = "block", "allow"

# Vocabulary of the default labelled table: common words of kinds of sites that are blocked
# anywhere, one line a kind (gambling, pills, sex, spam and search tricks, advertising, stolen
# software and fraud), and everyday words of ordinary sites, written down from general knowledge.
UNWANTED = (
    "casino poker roulette blackjack jackpot slots bet bets betting bingo lottery wager gamble win",
    "pills viagra cialis meds pharmacy steroids diet discount cheap tablets",
    "adult xxx porn sex nude escort webcam erotic dating",
    "spam seo backlinks traffic links clicks followers boost",
    "ads ad adserver banner popup tracker tracking track pixel affiliate",
    "crack warez keygen torrent serial phishing payday loans prize free",
)
ORDINARY = """
library garden news city recipes university docs museum history weather travel school music forum chess health science books
theatre gallery orchard hospital office parliament court police station railway
airport harbour bridge village county region nation state embassy ministry council election economy finance bank market trade
industry factory engine machine computer software network data research journal article paper thesis method theory logic number
algebra geometry biology chemistry medicine doctor clinic nurse dentist insurance family children parents kitchen bakery coffee
restaurant hotel holiday island mountain river ocean forest animal bird horse flower tree farmhouse tractor agriculture water
solar planet star rocket camera photo painting design fashion clothes shoes jewellery furniture house building architecture road
bicycle car truck train boat flight map country language english german french spanish dictionary grammar teacher student exam
career job work project team club sport football tennis swimming running winter summer spring autumn festival concert guitar
piano orchestra film television radio magazine letter postcard shop store catalogue review guide help about contact support
alphabet better shadow address header spelling pillow between another tradition mention nature feature weekend together
""".split()
# Subdomains and paths, given to both kinds alike.
SUBDOMAINS = ("", "www.", "m.", "blog.")
DOMAINS = (".test", ".site.test", ".pages.test")
PATHS = ("/", "/en/12", "/de/340", "/fr/8.html", "/es/77?page=2", "/en/about", "/index", "/de/3#top")
# Blocked hosts per word, of words of its kind and with ordinary words; there are as many ordinary
# ones, of far more words.
PARTNERS = 10
ORDINARY_PARTNERS = 4

# (pattern, verdict); a pattern is a host, which stands for its subdomains too, and the path's start.
RULES = [("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW)]


def host_of(url: Column) -> Column:
    """From the first :// up to / ? # or the end, A-Z as a-z; empty without :// or url."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without :// or url."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(pattern: str) -> Column:
    host, slash, rest = pattern.partition("/")
    own = (F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))
    return own & F.startswith("path", F.lit(slash + rest))


def rule_of(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest pattern that fits, and its verdict; both null if none does. Of equally long ones
    the first listed; a list of hundreds is meant, not a table."""
    pattern = verdict = F.lit(None).cast("string")
    for text, said in sorted(reversed(rules), key=lambda r: len(r[0])):
        pattern = F.when(_fits(text), F.lit(text)).otherwise(pattern)
        verdict = F.when(_fits(text), F.lit(said)).otherwise(verdict)
    return pattern, verdict


def _grams(name: str, mark: str) -> Column:
    """Marked n-grams of a column of text between two edge marks; ``<name>_chars`` has its characters."""
    chars = F.col(f"{name}_chars")

    def of(n: int) -> Column:
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(1), F.size(chars) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(chars, i, n), "")))

    return F.concat(*[of(n) for n in SIZES])


def with_grams(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path) with ``grams``. A gap between long chains of functions keeps the
    characters from being split again for every n-gram."""
    for name in ("host", "path"):
        pages = pages.withColumn(f"{name}_chars", F.split(F.concat(F.lit("^"), F.col(name), F.lit("$")), ""))
    grams = F.concat(_grams("host", "h"), _grams("path", "p"))
    return pages.withColumn("grams", grams).drop("host_chars", "path_chars")


def _hosts(words: list[str], n: int) -> list[str]:
    """``n`` names of one or two words: every word alone, then with others at growing distances."""
    names = list(words)
    for step in range(1, len(words)):
        joint = "-" if step % 2 else ""
        names += [f"{w}{joint}{words[(i + step) % len(words)]}" for i, w in enumerate(words)]
    return names[:n]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label) of the default labelled table, some 1,500 rows; label 1 is to be blocked. Hosts
    are built from the vocabulary by a rule, and no table that is judged adds to them."""
    kinds = [kind.split() for kind in UNWANTED]
    unwanted = [host for words in kinds for host in _hosts(words, PARTNERS * len(words))]
    mixed = enumerate(w for words in kinds for w in words for _ in range(ORDINARY_PARTNERS))
    unwanted += ["-".join((w, ORDINARY[i % len(ORDINARY)])[:: 1 if i % 2 else -1]) for i, w in mixed]
    ordinary = _hosts(ORDINARY, len(unwanted))

    def listed(hosts: list[str], label: float) -> list[tuple[str, float]]:
        places = enumerate(hosts)
        return [
            (f"http://{SUBDOMAINS[i % 4]}{h}{DOMAINS[i % 3]}{PATHS[i // 4 % 8]}", label) for i, h in places
        ]

    return spark.createDataFrame(listed(unwanted, 1.0) + listed(ordinary, 0.0), "url string, label double")


@dataclass
class Model:
    hashing: HashingTF
    regression: LogisticRegressionModel


def fit(labelled: DataFrame) -> Model:
    """Train on (url, label). The table is small; one partition in a fixed order makes equal
    models of equal tables. Rows with a null label are left out."""
    rows = labelled.filter("label IS NOT NULL").select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("double").alias("label")
    )
    rows = rows.coalesce(1).sortWithinPartitions("host", "path", "label")
    hashing = HashingTF(numFeatures=N_FEATURES, binary=True, inputCol="grams", outputCol="features")
    regression = LogisticRegression(regParam=REGULARISATION, maxIter=ITERATIONS, standardization=False)
    return Model(hashing, regression.fit(hashing.transform(with_grams(rows))))


def judge(pages: DataFrame, model: Model, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, score, verdict.

    ``rule`` is the longest rule that fits, or null; then the verdict is the rule's, else ``block``
    if ``score``, the probability of label 1, is at least a half. A null url, or one without ://,
    has an empty host and path and is judged all the same. Repeated rows are judged alike; other
    columns are ignored.
    """
    pattern, verdict = rule_of(RULES if rules is None else rules)
    located = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    featured = model.hashing.transform(with_grams(located))
    scored = model.regression.transform(featured).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    said = F.when(F.col("score") >= THRESHOLD, BLOCK).otherwise(ALLOW)
    return scored.select("page_id", "host", "path", pattern.alias("rule"), "score", F.coalesce(verdict, said).alias("verdict"))
