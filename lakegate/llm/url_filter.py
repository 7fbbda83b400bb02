"""URL filter: rule list, then logistic regression on hashed character n-grams (native).

The classifier reads character n-grams of the host's and the path's words,
hashed to a fixed number of features, and is fitted by Spark's own logistic
regression on a small labelled URL table, a parameter; nothing else is learned.

Defined results
* a null url, or one without ``://``, has an empty host and path, no rule, and the
  verdict of a URL without features (allow under any table with mostly allowed URLs).
* of the rules that fit the longest wins; equally long ones in the order given.
* repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = 1 << 14
GRAMS = (3, 4, 5)
REGULARISATION = 0.002

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

# Labelled example sites and paths, of kinds that web corpora leave out and ordinary ones.  Sites of both kinds get
# each of PATHS, so that languages and numbers say nothing, and paths of their own kind; ordinary sites get
# paths to block too, so that paths tell on any host.
PATHS = ("/en/12", "/de/7.html", "/fr/30/", "/es/5", "/")
BLOCKED_PATHS = """
/casino/slots /slots/free-spins /free-bonus /casino/bonus /poker/cash /roulette/spin /sports-betting/odds /bets/live
/betting-tips /win-prizes/claim /cheap-pills/order /viagra/buy /online-pharmacy /diet-pills /adult/videos /xxx/watch
/porn/view /sexcams/live /escort-girls /warez/keygen /torrent/crack /payday-loans/apply /popup-ads/click
/adtrack/pixel /spam/backlinks /link-farm /replica-watches/rolex /get-rich-quick /hacked-accounts /free-money
"""
ALLOWED_PATHS = """
/wiki/physics /docs/guide /news/weather /blog/garden /article/history /law/article /src/index.html /release/notes
/research/paper.pdf /recipes/bread /library/books /about /contact /page /music/song /school/lessons /travel/mountains
/football/result /science/ocean /help/questions /archive/letters /museum/art /forum/topic /category/house
/project/readme /economy/report /family/children /health/hospital /radio/station /tag/poetry
"""
BLOCKED = """
casino-online.test casino.test www.bestcasino.test m.lucky-casino.test blog.casino-bonus.test poker-win.test
bigwin-slots.test win-prizes.test sport-bets.test bets-online.test free-bets-now.test betting-tips.test
free-spins.test free-money.test cheap-meds.test cheap-viagra.test www.discount-pills.test pills-store.test
online-pharmacy-cheap.test diet-pills.test cheap-loans.test adult-videos.test www.adult-chat.test adult.test xxx-tube.test
hot-porn.test sexcams.test escort-girls.test spam-links.test spam.test buy-spam-list.test link-farm.test
content-farm.test seo-farm.test ads-server.test ads.test popup-ads.test adtrack.test track-clicks.test ads-tracker.test
clicktrack.test tracking-pixel.test warez-crack.test torrent-warez.test replica-watches.test payday-loans.test
get-rich-quick.test hacked-accounts.test adult-movies.test blog.adult-dating.test m.adult-cams.test bets.test
www.live-bets.test free-casino.test
"""
ALLOWED = """
news.test www.daily-news.test blog.garden.test m.weather.test thesis.test therapy.test museum.test library.test
university.test www.research.test m.recipes.test blog.travel.test theatre.test history.test science.test
mathematics.test physics.test chemistry.test www.encyclopedia.test docs.project.test forum.cooking.test
blog.author.test m.station.test government.test hospital.test school.test www.nature.test mountain.test ocean.test
blog.northern.test m.thunder.test anthem.test other.test www.there.test thing.test station.test motion.test
nation.test table.test their.test m.mother.test blog.weather.test feather.test with.test that.test when.test
where.test wheel.test bread.test house.test m.mouth.test www.song.test poetry.test letters.test art.test film.test
radio.test music.test village.test blog.family.test sports.test football.test chess.test software.test code.test
opensource.test statistics.test economy.test farmers-market.test railway.test winter.test window.test freedom.test
addresses.test blog.wins-and-losses.test adults-education.test
family-farm.test www.farm-museum.test green-farms.test music-now.test
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table ``url, label`` (1: block)."""
    blocked, allowed, telling, ordinary = (x.split() for x in (BLOCKED, ALLOWED, BLOCKED_PATHS, ALLOWED_PATHS))
    rows = [(u + p, y) for y, sites in ((1, blocked), (0, allowed)) for u in sites for p in PATHS]
    for y, sites, paths, each in ((1, blocked, telling, 2), (1, allowed, telling, 2), (0, allowed, ordinary, 6)):
        rows += [(u + paths[(each * i + k) % len(paths)], y) for i, u in enumerate(sites) for k in range(each)]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('https://{u}', {y})" for u, y in rows) + " AS t(url, label)")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def grams(host: Column, path: Column, sizes: tuple[int, ...] = GRAMS) -> Column:
    """Distinct n-grams of the words of the host without its last label, and of the path's letters."""
    def cut(words: Column, mark: str) -> Column:
        framed = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit("<"), w, F.lit(">")))
        return F.flatten(F.transform(framed, lambda w: F.flatten(F.array(*[
            F.transform(F.when(F.length(w) >= n, F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))))
                        .otherwise(F.array().cast("array<int>")),
                        lambda i, n=n: F.concat(F.lit(mark), w.substr(i, F.lit(n)))) for n in sizes]))))
    labels = F.split(F.regexp_replace(host, "\\.?[^.]*$", ""), "[^a-z]+")
    steps = F.split(F.lower(path), "[^a-z]+")
    return F.array_distinct(F.concat(cut(labels, "h"), cut(steps, "p")))


def with_features(urls: DataFrame) -> DataFrame:
    framed = (urls.withColumn("_host", host_of(F.col("url"))).withColumn("_path", path_of(F.col("url")))
              .withColumn("_grams", grams(F.col("_host"), F.col("_path"))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features").transform(framed)


def train(labelled: DataFrame, regularisation: float = REGULARISATION) -> LogisticRegressionModel:
    """Fit on a small labelled table ``url, label``."""
    fitted = with_features(labelled.coalesce(1)).select("_features", F.col("label").cast("double").alias("label")).cache()
    model = LogisticRegression(featuresCol="_features", regParam=regularisation, standardization=False, maxIter=60,
                               predictionCol="_p", probabilityCol="_probability", rawPredictionCol="_raw").fit(fitted)
    fitted.unpersist()
    return model


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Index of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: (len(rules[i][1]), -i)):
        rule_host, slash, rest = rules[i][1].partition("/")
        fits = (host == rule_host) | host.endswith("." + rule_host)
        chosen = F.when(fits & path.startswith(slash + rest), F.lit(i)).otherwise(chosen)
    return chosen


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: tuple[tuple[str, str], ...] = RULES,
          threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` per row of ``pages``."""
    scored = model.transform(with_features(pages.select("page_id", "url")))
    at = matching_rule(F.col("_host"), F.col("_path"), rules)
    score = vector_to_array("_probability")[1]
    out = scored.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), at.alias("_at"),
                        score.alias("block_score"))
    names, actions = (F.array(*[F.lit(r[k]) for r in rules]) if rules else F.array().cast("array<string>") for k in (1, 0))
    known = F.when(F.col("_at").isNotNull(), F.get(names, F.col("_at")))
    said = F.when(F.col("_at").isNotNull(), F.get(actions, F.col("_at")))
    learned = F.when(F.col("block_score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", known.alias("rule"), F.coalesce(said, learned).alias("verdict"), "block_score")
