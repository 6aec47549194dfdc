"""Allow or block urls: rules first, else logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path begins with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ://, ASCII letters in lower case) and path; both empty for NULL or
    for a url without ://."""
    start = F.coalesce(F.instr(url, "://"), F.lit(0))
    after = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    rest = F.substring(after, F.length(host) + 1, F.length(after))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^?#]*", 0)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, NULL if none does; of equally long ones
    the longer host, then block. The rules are a short list that the caller gives."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block"))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(order):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


class UrlModel:
    """Logistic regression over hashed character n-grams of host and path, without Python workers."""

    def __init__(self, sizes: Sequence[int] = (3, 4), features: int = 1 << 15):
        self.sizes, self.features = sizes, features
        self.fitted: LogisticRegressionModel | None = None
        self.only = "allow"

    def featured(self, rows: DataFrame) -> DataFrame:
        """Add ``features`` to rows with ``host`` and ``path``; ^ and $ mark the ends of the host."""
        text = F.concat(F.lit("^"), "host", F.lit("$"), "path")
        rows = rows.withColumn("letters", F.split(text, ""))
        grams = []
        for n in self.sizes:
            rows = NGram(n=n, inputCol="letters", outputCol=f"grams{n}").transform(rows)
            grams.append(f"grams{n}")
        rows = rows.withColumn("grams", F.concat(*grams))
        rows = HashingTF(numFeatures=self.features, binary=True, inputCol="grams", outputCol="features").transform(rows)
        return rows.drop("letters", "grams", *grams)

    def fit(self, labelled: DataFrame, most_rows: int = 20_000, iterations: int = 60, strength: float = 1e-2) -> UrlModel:
        """Train on ``labelled`` (host, path, verdict), at most ``most_rows`` distinct rows of it,
        those with the least hash. Both verdicts weigh the same in all, and the penalty keeps few
        n-grams from deciding alone. Without rows every verdict is allow; with one verdict, that."""
        rows = (
            labelled.select("host", "path", "verdict").where(F.col("verdict").isin("allow", "block")).distinct()
            .orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(most_rows)
            .withColumn("label", (F.col("verdict") == "block").cast("double"))
        ).persist()
        try:
            count, blocked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
            if count and 0 < blocked < count:
                even = F.when(F.col("label") == 1, count / (2 * blocked)).otherwise(count / (2 * (count - blocked)))
                learner = LogisticRegression(
                    maxIter=iterations, regParam=strength, standardization=False, weightCol="weight"
                )
                self.fitted = learner.fit(self.featured(rows).select("features", "label", even.alias("weight")))
            elif count:
                self.only = "block" if blocked else "allow"
        finally:
            rows.unpersist()
        return self

    def verdicts(self, rows: DataFrame) -> DataFrame:
        """Add ``blocked`` (probability) to rows with host and path."""
        if self.fitted is None:
            return rows.withColumn("blocked", F.lit(1.0 if self.only == "block" else 0.0))
        scored = self.fitted.transform(self.featured(rows))
        return scored.withColumn("blocked", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )


def decided_by_rules(parts: DataFrame) -> DataFrame:
    """(host, path, verdict) of the rows whose ``found`` holds a rule."""
    return parts.where(F.col("found").isNotNull()).select("host", "path", F.col("found.verdict").alias("verdict"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    most_rows: int = 20_000,
) -> DataFrame:
    """A verdict for every row: page_id, host, path, rule, verdict, blocked (the model's
    probability that it should be blocked).

    The longest rule that fits decides; where none does, the model decides: block from 0.5 on. It is
    trained on ``labelled`` (url, verdict), or else on those of ``pages`` that a rule decides, with the
    rule's verdict; urls that no rule decides have no label and are not trained on.
    At most ``most_rows`` of the labelled urls are used, which is the bound of the training sample.
    All rows are judged.
    NULL urls and urls without :// have an empty host and path, which no rule fits; the model judges
    them like others. Repeated rows are judged each; an empty table gives an empty table.
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn(
        "found", fitting_rule(F.col("host"), F.col("path"), rules)
    )
    if labelled is None:
        known = decided_by_rules(parts)
    else:
        host, path = url_parts(F.col("url"))
        known = labelled.select(host.alias("host"), path.alias("path"), "verdict")
    model = UrlModel().fit(known, most_rows)
    decided = F.when(F.col("blocked") >= 0.5, "block").otherwise("allow")
    return model.verdicts(parts).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), decided).alias("verdict"), "blocked",
    )
