"""Personal data in whole texts, by weakly supervised span labelling, in SQL functions only.

Patterns find candidate spans.  Regex, gazetteer and context labellers vote on
each; how often each pattern of votes occurs is all that expectation-
maximisation needs to estimate the labellers' reliabilities.  The posterior
labels of a bounded sample train a logistic span classifier, whose weights
become one SQL expression.  Spans of the four base kinds that pass their check
always stay; the classifier decides on the looser ones.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakepipe.session import scratch_path

# Matches are the same as those of the plain patterns; the look-behinds and possessive loops keep long runs linear.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ \-]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: Looser kinds: (pattern, what a text must contain)
LOOSE = {
    "hidden_email": (rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[\(\[]at[\)\]] ?[A-Za-z0-9-]++ ?(?:\.|[\(\[]dot[\)\]]) ?[A-Za-z]{{2,}}", "at"),
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}(?![0-9])",
    "national_id": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "person": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Herr|Frau|Madame|Monsieur|Señor|Señora)\.? [A-Z][a-z]{2,}+(?: [A-Z][a-z]{2,}+)?",
}
_ORDER = [*BASE, *LOOSE]

GAZETTEER = (
    "james mary john anna maria robert michael linda david sarah thomas laura peter julia paul emma "
    "hans karl ursula klaus jean pierre marie claire luc jose juan carmen luis ana pablo "
    "gmail yahoo hotmail outlook example mail DE FR ES GB NL IT AT CH"
).split()
CONTEXT = "phone tel call mobile mail email e-mail contact write address card visa account iban ssn name dear kontakt telefon appel correo".split()
AGAINST = "version page isbn figure price chapter section total token password key id order".split()
_VOTES = ("shape", "gazetteer", "context", "against", "digits")


def _pattern(kind: str) -> tuple[str, str]:
    if kind in BASE:
        return BASE[kind], _NEEDS[kind]
    found = LOOSE[kind]
    return found if isinstance(found, tuple) else (found, "")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 1, d * 2).otherwise(d)
        return total + doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _valid(kind: str, m: Column) -> Column:
    """The check a match must pass."""
    n = F.length(_digits(m))
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return F.length(m).between(15, 34)
    if kind == "national_id":
        return ~m.rlike("^(?:000|666|9)")
    return F.lit(True)


def _words(words: list[str]) -> str:
    return "(?i)(?<![A-Za-z])(?:" + "|".join(words) + ")(?![A-Za-z])"


def _found(kind: str) -> tuple[Column, Column]:
    """The leftmost matches of a pattern in the column ``t``, and the pieces of text between them."""
    pattern, needs = _pattern(kind)
    none = F.array().cast("array<string>")
    hits = F.regexp_extract_all(F.col("t"), F.lit(pattern), F.lit(0))
    hits = F.when(F.contains(F.col("t"), F.lit(needs)), hits).otherwise(none) if needs else hits
    return hits, F.when(F.size(f"m_{kind}") > 0, F.split(F.col("t"), pattern, -1)).otherwise(none)


def _spans(kind: str) -> Column:
    """Array of what is known of each match by itself: the labellers' votes, and lengths from which its place follows.

    Matches and pieces are columns made before, so a text is searched once
    whatever the number of its matches.
    """
    found, between = F.col(f"m_{kind}"), F.col(f"b_{kind}")

    def vote(yes: Column, no: Column | None = None) -> Column:
        """2 yes, 1 no, 0 abstain."""
        out = F.when(yes, 2)
        return out.otherwise(0) if no is None else out.when(no, 1).otherwise(0)

    def span(m: Column, i: Column) -> Column:
        before, after = F.get(between, i), F.get(between, i + 1)
        around = F.concat_ws(" ", F.right(before, F.lit(40)), F.left(after, F.lit(20)))
        valid = _valid(kind, m)
        digits = _digits(m)
        distinct = F.size(F.array_distinct(F.split(digits, "")))
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            F.length(before).alias("gap"),
            F.length(m).alias("size"),
            valid.alias("valid"),
            F.struct(
                vote(valid, ~valid).alias("shape"),
                vote(m.rlike(_words(GAZETTEER))).alias("gazetteer"),
                vote(around.rlike(_words(CONTEXT))).alias("context"),
                F.when(around.rlike(_words(AGAINST)), 1).otherwise(0).alias("against"),
                vote(distinct >= 4, (F.length(digits) > 0) & (distinct < 4)).alias("digits"),
            ).alias("votes"),
            F.least(F.length(m), F.lit(64)).alias("length"),
            (F.length(digits) / F.greatest(F.length(m), F.lit(1))).alias("digit_share"),
        )

    return F.transform(found, span)


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Posterior of personal data for each pattern of votes (2 yes, 1 no, 0 abstain), by expectation-maximisation."""
    q = {p: 0.9 if p.count(2) > p.count(1) and p[0] == 2 else 0.1 for p, _ in patterns}
    for _ in range(rounds):
        yes = sum(n * q[p] for p, n in patterns)
        total = sum(n for _, n in patterns)
        prior = min(max(yes / total, 0.01), 0.99) if total else 0.5
        logs = []
        for j in range(len(_VOTES)):
            rates = []
            for c in (0, 1):
                n = [sum(k * (q[p] if c else 1 - q[p]) for p, k in patterns if p[j] == v) + 1.0 for v in (1, 2)]
                rates.append([x / sum(n) for x in n])
            logs.append([math.log(rates[1][v] / rates[0][v]) for v in (0, 1)])
        q = {
            p: 1 / (1 + math.exp(-min(max(math.log(prior / (1 - prior)) + sum(logs[j][v - 1] for j, v in enumerate(p) if v), -30), 30)))
            for p, _ in patterns
        }
    return q


def _features(span: Column) -> dict[str, Column]:
    votes = {f"{v}_{w}": (span["votes"][v] == k).cast("double") for v in _VOTES for k, w in ((1, "no"), (2, "yes"))}
    shape = {"length": span["length"].cast("double") / 64.0, "digit_share": span["digit_share"]}
    return votes | shape | {f"kind_{k}": (span["kind"] == k).cast("double") for k in _ORDER}


def _classifier(spans: DataFrame, max_spans: int):
    """Span -> probability, as a function of columns: the trained classifier's weights in one expression."""
    fields = [F.col("s")["votes"][v].alias(v) for v in _VOTES]
    counted = spans.groupBy(*fields).count().collect()  # at most 3 ** labellers rows
    patterns = [(tuple(r[v] for v in _VOTES), r["count"]) for r in counted]
    q = estimate(patterns)
    if not patterns or min(q.values()) >= 0.5 or max(q.values()) < 0.5:
        always = 1.0 if patterns and min(q.values()) >= 0.5 else 0.0
        return lambda span: F.lit(always)
    posterior = F.lit(0.0)
    for p, x in q.items():
        same = F.lit(True)
        for v, k in zip(_VOTES, p):
            same = same & (F.col("s")["votes"][v] == k)
        posterior = F.when(same, x).otherwise(posterior)
    names = list(_features(F.col("s")))
    sample = spans.orderBy("h", "s").limit(max_spans).withColumn("q", posterior)
    rows = sample.select(
        (F.col("q") >= 0.5).cast("double").alias("label"),
        F.abs(F.col("q") * 2 - 1).alias("weight"),
        *(c.alias(n) for n, c in _features(F.col("s")).items()),
    ).coalesce(1)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    fitted = LogisticRegression(weightCol="weight", regParam=0.01, maxIter=50).fit(rows)
    weights, bias = fitted.coefficients.toArray().tolist(), float(fitted.intercept)

    def probability(span: Column) -> Column:
        z = F.lit(bias)
        for (_, c), w in zip(_features(span).items(), weights):
            if w:
                z = z + c * F.lit(w)
        return 1.0 / (1.0 + F.exp(-z))

    return probability


def personal_data(
    docs: DataFrame, threshold: float = 0.5, max_spans: int = 20000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and ``base_sha256`` are of the base spans; ``spans`` has these
    and the looser ones with a probability of at least ``threshold`` that touch
    no base span, as ``kind:start:end`` by start, then kind, joined by commas.
    Null and empty texts have no spans; repeated rows and null ids are kept;
    other columns are ignored.  The labellers' reliabilities come from the
    spans of all texts, the classifier learns from at most ``max_spans``.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pii")
    rows = docs.select(F.monotonically_increasing_id().alias("r"), F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumns({f"m_{k}": _found(k)[0] for k in _ORDER})
    rows = rows.withColumns({f"b_{k}": _found(k)[1] for k in _ORDER})
    # Stored: the number of a row, once given, stays with it.
    rows.select("r", "i", F.concat(*[_spans(k) for k in _ORDER]).alias("found")).write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    # The spans of a text come together once; places, overlaps and lists are passes along them.
    spans = found.select("r", F.explode("found").alias("s")).repartition("r")
    up_to = Window.partitionBy("r", "s.kind").orderBy("s.nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("s.gap") + F.col("s.size")).over(up_to)
    placed = spans.select("r", "s", (end - F.col("s.size")).alias("start"), end.alias("end"))
    placed.write.parquet(f"{path}/placed")
    placed = spark.read.parquet(f"{path}/placed")
    probability = _classifier(placed.select("s", F.xxhash64("r", "start", "end", "s.kind").alias("h")), max_spans)
    kind, valid = F.col("s.kind"), F.col("s.valid")
    is_base = kind.isin(*BASE) & valid
    # A looser span stays where no base span that starts at or before it reaches into it and none starts inside it.
    along = Window.partitionBy("r").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.partitionBy("r").orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    placed = placed.repartition("r").withColumns(
        {"base": is_base, "reach": F.max(F.when(is_base, F.col("end"))).over(along), "next": F.min(F.when(is_base, F.col("start"))).over(onward)}
    )
    free = ~(F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False)))
    kept = placed.where(F.col("base") | (~kind.isin(*BASE) & valid & (probability(F.col("s")) >= threshold) & free))
    rank = F.array_position(F.array(*[F.lit(k) for k in _ORDER]), kind)
    entry = F.struct("start", rank.alias("rank"), F.concat_ws(":", kind, "start", "end").alias("span"))

    def listed(which: Column) -> Column:
        """Spans of a text by start, then kind as listed, joined."""
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(which, entry))), lambda x: x["span"]), ",")

    lists = kept.groupBy("r").agg(
        *(F.count(F.when(F.col("base") & (kind == k), 1)).alias(f"n_{k}") for k in BASE), listed(F.col("base")).alias("base_spans"), listed(F.lit(True)).alias("spans")
    )
    out = found.select("r", "i").join(lists, "r", "left")
    return out.select(
        F.col("i").alias(id_col),
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
