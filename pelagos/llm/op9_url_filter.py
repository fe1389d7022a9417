"""URL filter: allow and block rules, then a logistic regression on hashed character n-grams
of host and path, trained from a small labelled URL table (native: MLlib runs in the JVM).

The labelled table is built by a rule (labelled_urls) from some 120 harmless and 54 unwanted words,
about 1000 URLs, none of them on a host of `pages`.

A rule fits its host and all subdomains if the path starts with the rule's path; the longest
wins (host, then path). Where none fits, the regression's verdict holds.

Defined results: a null url, or one without `://`, has an empty host and path and is judged
by the regression on no n-gram at all (its intercept); repeated rows are judged alike; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos.session import table

NAME = "op9_url_regression"
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
FEATURES, GRAMS = 1 << 14, (3, 4)

#: What the labelled URLs are about.
GOOD = (
    "library museum gardening harbour recipes university compiler travel weather history chess cinema theatre birds maths physics chemistry biology geology astronomy "
    "painting sculpture poetry novels grammar dictionary languages cooking baking cycling sailing hiking climbing swimming football tennis orchestra choir guitar piano "
    "newspaper journal magazine parliament council hospital school kindergarten railway airport bridge architecture carpentry pottery knitting photography philosophy "
    "economics statistics law medicine nursing farming forestry fishing beekeeping vineyard mountain river island village market bakery science research nature thinking other "
    "the this that than then there they what when with within where which north south earth month truth theory station nation question answer time people world home house hand life work year day night water"
).split()
BAD = (
    "adult xxx porn sex cams escort dating casino poker bets betting jackpot slots roulette lottery gambling ads adserver track tracker tracking clicks banner popunder "
    "affiliate pills meds pharma viagra cialis steroids spam farm links seo backlinks replica watches handbags payday loans credit bitcoin-doubler prize winner giveaway "
    "warez torrent crack keygen malware phishing followers likes"
).split()
LURES = ("cheap", "free", "best", "win", "online", "x", "bonus", "buy", "fast", "hot")
PAGES = ("en/{n}", "de/{n}.html", "fr/{n}?page=2", "es/{n}#top", "en/{n}/", "en/{n}?utm_source=feed&ref=x")


def labelled_urls() -> tuple:
    """The labelled table, 1 = block: each topic on a plain host and beside six
    others (most URLs are harmless), each bad one also with lures before and after it, over subdomains, domains, languages and page forms in turn."""
    subs, tops = ("", "www.", "blog.", "m."), ("com", "net", "org", "info")
    hosts = [(w, 0) for w in GOOD] + [(f"{w}{'-' if k % 2 else ''}{GOOD[((6 * k + 1) * i + k) % len(GOOD)]}", 0) for k in range(1, 7) for i, w in enumerate(GOOD)]
    hosts += [(w, 1) for w in BAD] + [(f"{LURES[i % len(LURES)]}-{w}", 1) for i, w in enumerate(BAD)] + [(f"{w}-{LURES[(3 * i + 1) % len(LURES)]}", 1) for i, w in enumerate(BAD)]
    return tuple((f"http{'s' * (i % 2)}://{subs[i % 4]}{h}.example{i % 3}.{tops[i // 2 % 4]}/{PAGES[i % len(PAGES)].format(n=37 * i % 1000)}", y) for i, (h, y) in enumerate(hosts))


LABELLED = labelled_urls()


def parts(urls: DataFrame) -> DataFrame:
    """Adds host and path. translate() lower-cases A-Z alone."""
    at = F.locate("://", F.coalesce(F.col("url"), F.lit("")))
    rest = F.when(at > 0, F.col("url").substr(at + 3, F.length("url"))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return urls.withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def ruled(df: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Adds rule and the rule's verdict. The rules are tried from the longest on."""
    rule = verdict = None
    for host, path, say in sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)) if rule is None else rule.when(fits, F.lit(host + path))
        verdict = F.when(fits, F.lit(say)) if verdict is None else verdict.when(fits, F.lit(say))
    return df.withColumn("rule", rule).withColumn("by_rule", verdict)


def grams(df: DataFrame) -> DataFrame:
    """n-grams of host and path, marked by where they come from; digits count as one."""
    def of(col: str, mark: str, n: int):
        text = F.concat(F.lit("^"), F.regexp_replace(F.col(col), "[0-9]+", "0"), F.lit("$"))
        last = F.length(text) - (n - 1)
        return F.when((last > 0) & (F.length(col) > 0), F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))
    return df.withColumn("grams", F.concat(*[of(c, m, n) for c, m in (("host", "h:"), ("path", "p:")) for n in GRAMS]))


def train(spark: SparkSession, labelled: tuple = LABELLED):
    """The regression on the labelled table; its size is fixed by that table, not by the corpus."""
    values = ", ".join("('{}', {}D)".format(u.replace("'", "''"), y) for u, y in labelled)
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)").coalesce(1)
    return LogisticRegression(regParam=0.001, maxIter=50, standardization=False).fit(hashed(grams(parts(rows))))


def hashed(df: DataFrame) -> DataFrame:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(df)


def judge(urls: DataFrame, rules: tuple = RULES, labelled: tuple = LABELLED) -> DataFrame:
    """page_id, host, path, rule, verdict and the regression's probability of block."""
    model = train(urls.sparkSession, labelled)
    df = hashed(grams(ruled(parts(urls.select("page_id", "url")), rules)))
    out = model.transform(df).withColumn("p_block", F.round(vector_to_array("probability")[1], 6))
    verdict = F.coalesce(F.col("by_rule"), F.when(F.col("p_block") > 0.5, "block").otherwise("allow"))
    return out.select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", verdict.alias("verdict"), "p_block")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


ORACLE_SQL = None  # fitting a regression is tested against a brute-force version
