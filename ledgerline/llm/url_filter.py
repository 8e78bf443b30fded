"""URL filter: rules first, gradient-boosted trees on lexical features for the rest [native].

A rule is (host, path, verdict): it fits its host and all subdomains when the
url's path starts with the rule's path, and the longest rule that fits wins.
The urls that a rule decides are the labelled urls; boosted trees (Spark ML)
learn from them, on lexical features only, to judge the others: lengths,
depth, digit share, character entropy, parameter counts, hyphens, and
statistics of the host's suffix and of the path's first part: how common they
are among all pages, and how often labelled pages with them are blocked.

Training reads at most ``train_rows`` labelled urls, those of least hash; the
statistics cover every page.  With labels of one kind only, that kind
is the verdict for all; with none, ``allow``.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is judged on these like any other; repeated rows are judged one by one;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import let, lower_ascii, written

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path: up to ``/``, ``?``, ``#`` or the end after the first ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substr(url, mark + 3))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def entropy(c: Column) -> Column:
    """Bits per character of a text."""
    def of(chars: Column) -> Column:
        n = F.length(c).cast("double")
        share = F.transform(F.array_distinct(chars), lambda x: (n - F.length(F.replace(c, x, F.lit("")))) / n)
        return F.aggregate(share, F.lit(0.0), lambda a, p: a - p * F.log2(p))
    return F.when(F.length(c) > 0, let(F.split(c, ""), of)).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path) with lexical features."""
    url = F.coalesce("url", F.lit(""))
    count = lambda pattern: F.regexp_count(url, F.lit(pattern)).cast("double")
    size = F.greatest(F.length(url), F.lit(1))
    return pages.withColumns({
        "f_length": F.length(url).cast("double"), "f_host_length": F.length("host").cast("double"),
        "f_path_length": F.length("path").cast("double"),
        "f_depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
        "f_labels": F.regexp_count("host", F.lit(r"\.")).cast("double"),
        "f_digits": count("[0-9]") / size, "f_hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "f_entropy": entropy(url), "f_host_entropy": entropy(F.col("host")),
        "f_parameters": count("[?&][^=&#]*="), "f_fragment": count("#"), "f_escapes": count("%[0-9A-Fa-f]{2}"),
        "f_secure": F.startswith(url, F.lit("https:")).cast("double"),
        "suffix": F.regexp_extract("host", r"[^.]*\z", 0), "section": F.regexp_extract("path", "^/([^/]*)", 1)})


FOLDS = 5


def fold() -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")


def statistics(pages: DataFrame, labelled: DataFrame, key: str) -> DataFrame:
    """Per value of ``key``: how common it is among all pages; blocked and all labelled ones, in total and by fold."""
    seen = pages.groupBy(key).agg(F.log1p(F.count("*")).alias(f"f_{key}_count"))
    blocked = F.count_if(F.col("ruled") == BLOCK)
    parts = (labelled.where("ruled IS NOT NULL").groupBy(key, fold().alias("fold"))
             .agg(blocked.alias("blocked"), F.count("*").alias("n")))
    known = parts.groupBy(key).agg(
        F.sum("blocked").alias("__blocked"), F.sum("n").alias("__n"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("blocked", "n")))).alias("__folds"))   # FOLDS at most
    return written(seen.join(known, key, "left").withColumnRenamed(key, f"__{key}"), f"url-{key}")


def blocked_share(prior: float = 10.0) -> Column:
    """The share of blocked pages among the labelled ones of a key, drawn to one half by ``prior`` imagined pages.

    A labelled page sees those of other folds only, never its own label.
    """
    own = F.when(F.col("ruled").isNotNull(), F.try_element_at("__folds", fold()))
    blocked = F.coalesce("__blocked", F.lit(0)) - F.coalesce(own["blocked"], F.lit(0))
    n = F.coalesce("__n", F.lit(0)) - F.coalesce(own["n"], F.lit(0))
    return (blocked + prior / 2) / (n + prior)


OWN = ("f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_hyphens", "f_entropy",
       "f_host_entropy", "f_parameters", "f_fragment", "f_escapes", "f_secure")
KEYS = ("suffix", "section")
FEATURES = OWN + tuple(f"f_{k}_{x}" for k in KEYS for x in ("count", "blocked"))


def featurize(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """``pages`` (see ``with_rules``) with all features; the shares of blocked urls come from ``labelled`` pages.

    The shares of a page that a rule fits are out of fold, or the trees would
    learn from a page's own label.
    """
    out, known = lexical(pages), lexical(labelled)
    own = out
    for k in KEYS:
        out = out.join(statistics(own, known, k), F.col(k) == F.col(f"__{k}"), "left")
        out = out.withColumn(f"f_{k}_blocked", blocked_share()).drop(f"__{k}", "__blocked", "__n", "__folds")
    return out.fillna(0.5, [f"f_{k}_blocked" for k in KEYS]).fillna(0.0, list(FEATURES))


def train(labelled: DataFrame, train_rows: int = 20_000, trees: int = 15, depth: int = 4,
          seed: int = 42) -> PipelineModel | str:
    """A model of ``labelled`` pages (features and ``ruled``), or the only verdict that occurs."""
    label = (F.col("ruled") == BLOCK).cast("double").alias("label")
    drawn = (labelled.select(label, *FEATURES, F.xxhash64("url").alias("hash")).orderBy("hash").limit(train_rows)
             .persist())
    try:
        seen = {r["label"] for r in drawn.select("label").distinct().collect()}
        if len(seen) < 2:
            return BLOCK if seen == {1.0} else ALLOW
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.2,
                            seed=seed)
        return PipelineModel([vector, gbt.fit(vector.transform(drawn))])
    finally:
        drawn.unpersist()


def judge(features: DataFrame, model: PipelineModel | str) -> DataFrame:
    """``features`` with the model's verdict in ``judged``."""
    if isinstance(model, str):
        return features.withColumn("judged", F.lit(model))
    out = model.transform(features)
    return out.withColumn("judged", F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)).drop(
        "features", "rawPrediction", "probability", "prediction")


def with_rules(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url: str = "url") -> DataFrame:
    """id, url, host, path, and the rule that decides with its verdict (null where none fits)."""
    host, path = split_url(F.col(url))
    parts = pages.select(F.col(id_col), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    text, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.withColumns({"rule": text, "ruled": verdict})


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url: str = "url",
                **training) -> DataFrame:
    """id, host, path, rule, verdict for every page."""
    ruled = with_rules(pages, rules, id_col, url)
    known = featurize(ruled, ruled)
    model = train(known.where(F.col("ruled").isNotNull()), **training)
    return judge(known, model).select(id_col, "host", "path", "rule", F.coalesce("ruled", "judged").alias("verdict"))
