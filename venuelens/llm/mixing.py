"""Mixing to target weights: domain posteriors of a trained classifier, and document rates by projected-gradient least squares."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.storage import keep

TEXT_BUCKETS = 1 << 12


@dataclass
class Classifier:
    domains: list[str]
    model: LogisticRegressionModel | None
    prior: list[float] = field(default_factory=list)


def words(text: Column) -> Column:
    """Words between blanks and line ends; a NULL or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), "")


def _vectors(df: DataFrame) -> DataFrame:
    counted = HashingTF(inputCol="words", outputCol="counts", numFeatures=TEXT_BUCKETS).transform(df)
    return Normalizer(inputCol="counts", outputCol="features").transform(counted)


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: Sequence[str], id: str = "doc_id", text: str = "text", domain: str = "domain", most: int = 1000, longest: int = 20_000) -> Classifier:
    """Multinomial logistic regression of the domain on hashed words of the text.

    It is fitted on a bounded sample: up to `most` labelled documents a domain, of up to `longest` bytes, in an order that only depends on
    the id. Labels outside `domains`, NULLs and repeated ids with several labels are left out. With fewer than two domains in
    the sample posteriors are the sample's shares, or equal.
    """
    known = labelled.where(F.col(id).isNotNull() & F.col(domain).isin(*domains)).select(F.col(id).alias("_id"), F.col(domain).alias("_domain"))
    known = known.groupBy("_id").agg(F.min("_domain").alias("_domain"), F.max("_domain").alias("_other")).where("_domain = _other")
    chosen = None
    for name in domains:
        part = known.where(F.col("_domain") == name).select("_id", F.lit(name).alias("_domain")).orderBy(F.xxhash64("_id"), "_id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    narrow = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text")).where(F.octet_length("_text") <= longest)
    number = F.array_position(F.array(*[F.lit(x) for x in domains]), F.col("_domain")) - 1
    sample = narrow.join(F.broadcast(chosen), "_id").select(words(F.col("_text")).alias("words"), number.cast("double").alias("label"))
    sample = keep(_vectors(sample).select("features", "label")).coalesce(8)  # a bounded sample
    shares = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    if len(shares) < 2:
        prior = [1.0 if k in shares else 0.0 for k in range(len(domains))] if shares else [1 / len(domains)] * len(domains)
        return Classifier(list(domains), None, prior)
    model = LogisticRegression(maxIter=30, regParam=1e-4, family="multinomial").fit(sample)
    return Classifier(list(domains), model)


def posteriors(docs: DataFrame, classifier: Classifier, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tokens, p): words of each whole text and the probability of each domain. A map without a shuffle."""
    k = len(classifier.domains)
    counted = docs.select(F.col(id).alias("doc_id"), words(F.col(text).cast("string")).alias("words"))
    if classifier.model is None:
        return counted.select("doc_id", F.size("words").cast("long").alias("tokens"), F.array(*[F.lit(x) for x in classifier.prior]).alias("p"))
    scored = classifier.model.setProbabilityCol("probability").transform(_vectors(counted))
    # Domains beyond the last one of the sample have no class in the model, and probability 0. The array is taken once: inside a
    # lambda over domains, the model would run once for each of them.
    absent = F.array(*[F.lit(0.0)] * (k - classifier.model.numClasses)) if k > classifier.model.numClasses else F.array().cast("array<double>")
    return scored.select("doc_id", F.size("words").cast("long").alias("tokens"), F.concat(vector_to_array("probability"), absent).alias("p"))


def fit_rates(soft: DataFrame, targets: Sequence[float], total: float | str | None = None, rounds: int = 60, tolerance: float = 1e-4) -> tuple[DataFrame, list[float]]:
    """`soft` with a rate for each document, and what is left between expected and wanted domain tokens, as shares of the total.

    Wanted: r >= 0 with sum(r * tokens * p[k]) = total * targets[k] for every domain k. Projected gradient from r = 1 minimises the squared
    differences, whitened by M = sum(tokens * p p'): in that metric a step of length 1 goes down for certain, and where no rate is 0 it
    ends at once. A step moves every rate along p . u for one vector u of one number a domain, so rates are told by the list of u so far: each
    round is one aggregation to K sums over a narrow table, and only K sums and K * K once reach the driver.

    `total`: expected tokens in all, by default those of the documents; "no loss": the least at which every domain keeps its tokens. Without tokens rates are 1. A domain nobody belongs
    to can't reach its target: its difference remains and is returned.
    """
    k = len(targets)
    weights = [w / sum(targets) for w in targets]
    p = [F.col("p")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    first = soft.agg(F.sum("tokens").alias("n"), *[F.sum(F.col("tokens") * p[i] * p[j]).alias(f"m{i}_{j}") for i, j in pairs]).first()
    if not first["n"]:
        return soft.withColumn("rate", F.lit(1.0)), [0.0] * k
    size = float(first["n"])
    if total == "no loss":
        owned = soft.agg(*[F.sum(F.col("tokens") * p[i]).alias(f"t{i}") for i in range(k)]).first()
        total = max((owned[f"t{i}"] / w for i, w in enumerate(weights) if w > 0), default=size)
    wanted = [(total or size) / size * w for w in weights]
    m = [[first[f"m{min(i, j)}_{max(i, j)}"] / size for j in range(k)] for i in range(k)]
    inverse = _inverse([[m[i][j] + (1e-9 if i == j else 0.0) for j in range(k)] for i in range(k)])
    moves: list[list[float]] = []
    left = [0.0] * k
    best = (math.inf, 0)
    for _ in range(rounds + 1):
        rate = _rate(p, moves)
        sums = soft.agg(*[F.sum(F.col("tokens") * p[i] * rate).alias(f"s{i}") for i in range(k)]).first()
        left = [(sums[f"s{i}"] or 0.0) / size - wanted[i] for i in range(k)]
        worst = max(map(abs, left))
        best = min(best, (worst, len(moves)))
        if worst <= tolerance or len(moves) == rounds:
            break
        moves.append([sum(inverse[i][j] * left[j] for j in range(k)) for i in range(k)])
    return soft.withColumn("rate", _rate(p, moves)), left


def _rate(p: list[Column], moves: list[list[float]]) -> Column:
    if not moves:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in u]) for u in moves])

    def step(r: Column, u: Column) -> Column:
        along = F.lit(0.0)
        for i, x in enumerate(p):
            along = along + x * u[i]
        return F.greatest(F.lit(0.0), r - along)

    return F.aggregate(steps, F.lit(1.0), step)


def _inverse(m: list[list[float]]) -> list[list[float]]:
    """Of a small positive definite matrix, by Gauss-Jordan elimination."""
    k = len(m)
    a = [row[:] + [float(i == j) for j in range(k)] for i, row in enumerate(m)]
    for i in range(k):
        top = max(range(i, k), key=lambda r: abs(a[r][i]))
        a[i], a[top] = a[top], a[i]
        a[i] = [x / a[i][i] for x in a[i]]
        for r in range(k):
            if r != i:
                a[r] = [x - a[r][i] * y for x, y in zip(a[r], a[i])]
    return [row[k:] for row in a]


def mix(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id: str = "doc_id", text: str = "text", domain: str = "domain", total: float | str | None = None, seed: int = 7
) -> DataFrame:
    """One row per document: doc_id, tokens, domain (likeliest), p (posterior by domain), rate, copies.

    `labelled` (id, domain) trains the classifier; `targets` are the domains' shares of tokens after mixing. `copies` rounds the rate down
    or up by a hash of id and seed, so that its mean is the rate.

    NULL and empty texts have no tokens; they get the posterior of a text without words and the rate that goes with it. NULL ids stay; repeated
    rows get equal rates. An empty table gives no rows. Other columns are ignored.
    """
    names = list(targets)
    classifier = fit_classifier(docs, labelled, names, id, text, domain)
    soft = keep(posteriors(docs, classifier, id, text))
    rated, _ = fit_rates(soft, [targets[x] for x in names], total)
    at = F.array_position("p", F.array_max("p")).cast("int")
    share = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    out = rated.select(
        "doc_id", "tokens", F.element_at(F.array(*[F.lit(x) for x in names]), at).alias("domain"), "p", "rate", F.floor(F.col("rate") + share).alias("copies")
    )
    return out


def label_domains(docs: DataFrame, labels: DataFrame, id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """(id, domain) of labelled documents: the language of good ones, `low` for those of low quality or toxic. NULLs are left out."""
    narrow = docs.select(F.col(id).alias("_id"), F.col(lang).alias("_lang"))
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    found = labels.join(narrow, labels[id] == narrow["_id"]).select(labels[id].alias(id), F.when(good, F.col("_lang")).otherwise("low").alias("domain"))
    return found.where("domain is not null")
