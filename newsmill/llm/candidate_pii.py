"""Personal data by candidate generation and gradient boosting.

Base patterns find e-mail addresses, IP addresses, payment cards and phone numbers whose format holds. Wider generators
propose further, overlapping spans of the same kinds: addresses with a spelt `at`, numbers without a plus, other
separators. Boosted trees judge a proposal by its format and by the words and characters around it. They learn from the
base matches and from the same matches in the disguises that the generators look for, against proposals that no base
match overlaps; for each kind the least threshold that keeps the wanted precision on held-out proposals selects spans.
All proposals of all texts take part, those with equal features as one row that weighs their number.

Everything is DataFrame functions and Spark ML. Positions come from splitting a text at its matches: the lengths of the
parts before a match add up to where it starts.
"""

from __future__ import annotations

from math import isqrt

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.llm.positional_index import bounded, text_key
from newsmill.llm.tables import stored

KINDS = ("email", "ip", "card", "phone")
PARTS = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# The base formats. A possessive quantifier or a look-behind changes no match; it spares trying each start of a long run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What proposes further spans of each kind.
WIDE = {
    "email": r"(?<![\w.+-])[\w.+-]{1,64}\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?[\w-]{1,63}(?:\x20?(?:\.|[\[({]\x20?(?:dot|DOT)\x20?[\])}])\x20?[\w-]{1,63}){1,8}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?[.,]\x20?[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\(?0|\()[0-9][\x20()./0-9-]{5,24}[0-9](?![0-9])",
}
# Disguises in which base matches are shown to the trees as well: what to replace by what.
DISGUISES = {"email": ("@", " (at) "), "ip": (r"\.", ", "), "card": (r"([0-9]{4})[ -]?(?=[0-9])", "$1. "), "phone": (r"^\+[0-9]{1,3} ?", "0")}
HINTS = {
    "email": "mail|contact|write|correo|courriel|schreib|reach",
    "ip": r"\bip\b|host|server|address|client|connect|login|adresse",
    "card": "card|visa|credit|pay|karte|carte|tarjeta|amex",
    "phone": r"phone|call|tel\b|mobile|fax|dial|sms|telefon|whatsapp|ruf",
}
CONTEXT = 40  # characters before and after a proposal
LEAST_BINS, UNSAMPLED = 32, 10_000  # Spark ML reads all rows for the split points of features up to this number, or the square of the bins
PRECISION, LEAST_POSITIVE = 0.95, 5
FEATURES = ("f_kind", "f_length", "f_digits", "f_share", "f_runs", "f_variety", "f_at", "f_marks", "f_hint", "f_letter_before",
            "f_letter_after", "f_quoted", "f_joined", "f_digit_near")


def proposals(docs: DataFrame, text: str) -> DataFrame:
    """key, kind, base (whether a base format), at (number of the match), start, stop, match, before, after."""
    texts = docs.select(text_key(F.col(f"`{text}`")).alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    patterns = [(k, p, True) for k, p in BASE.items()] + [(k, p, False) for k, p in WIDE.items()]
    columns = []
    for kind, pattern, base in patterns:
        may = F.rlike("_t", F.lit(("@" if base else r"[\[({]") if kind == "email" else "[0-9]"))
        matches = F.when(may, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)))
        columns.append(F.when(F.size(matches) > 0, F.struct(
            F.lit(kind).alias("kind"), F.lit(base).alias("base"), matches.alias("matches"), F.split("_t", pattern, -1).alias("parts"))))
    each = texts.select("key", F.explode(F.filter(F.array(*columns), lambda x: x.isNotNull())).alias("g"))
    rows = each.select("key", "g.kind", "g.base", "g.parts", F.posexplode("g.matches").alias("at", "match")).select(
        "key", "kind", "base", "at", F.length(F.get("parts", F.col("at"))).alias("gap"), "match",
        F.substring(F.get("parts", F.col("at")), -CONTEXT, CONTEXT).alias("before"),
        F.substring(F.get("parts", F.col("at") + 1), 1, CONTEXT).alias("after"))
    rows = rows.groupBy("key", "kind", "base", "at").agg(*(F.any_value(c).alias(c) for c in ("gap", "match", "before", "after")))  # equal texts once
    upto = Window.partitionBy("key", "kind", "base").orderBy("at")  # the matches of one text
    stop = F.sum(F.col("gap") + F.length("match")).over(upto)
    return rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("match"))


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    reversed_ = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + luhn_term(F.substring(reversed_, i, F.lit(1)).cast("int"), i))
    return total % 10 == 0


def luhn_term(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def holds(kind: Column, match: Column) -> Column:
    """Whether a base match also has what its format asks for beyond the pattern."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", True).when(kind == "ip", F.rlike(match, F.lit(rf"^{PARTS}(?:\.{PARTS}){{3}}$")))
            .when(kind == "card", n.between(12, 19) & luhn(F.when(n.between(12, 19), digits).otherwise("0")) & (n >= 12))
            .otherwise(n.between(9, 15)))


def with_features(rows: DataFrame) -> DataFrame:
    """Format and context of each proposal as numbers. Checks that define a base format are no features."""
    digits, match = F.regexp_replace("match", "[^0-9]", ""), F.col("match")
    hint = F.lit(False)
    for kind, words in HINTS.items():
        hint = F.when(F.col("kind") == kind, F.rlike(F.lower("before"), F.lit(words))).otherwise(hint)
    last, first = F.substring("before", -1, 1), F.substring("after", 1, 1)
    number = {k: F.lit(float(i)) for i, k in enumerate(KINDS)}
    kind_number = F.lit(-1.0)
    for kind, value in number.items():
        kind_number = F.when(F.col("kind") == kind, value).otherwise(kind_number)
    values = {
        "f_kind": kind_number, "f_length": F.length(match), "f_digits": F.length(digits),
        "f_share": F.length(digits) / F.greatest(F.length(match), F.lit(1)),
        "f_runs": F.size(F.split(match, "[^0-9]+")), "f_variety": F.size(F.array_distinct(F.split(digits, ""))),
        "f_at": F.rlike(match, F.lit(r"@|\bat\b|\bAT\b")), "f_marks": F.length(F.regexp_replace(match, r"[\w\s]", "")), "f_hint": hint,
        "f_letter_before": F.rlike(last, F.lit(r"\w")), "f_letter_after": F.rlike(first, F.lit(r"\w")),
        "f_quoted": F.rlike(last, F.lit("[\"'=#:/]")) | F.rlike(first, F.lit("[\"'/]")), "f_joined": F.rlike(last, F.lit("[.,-]")),
        "f_digit_near": F.rlike(F.substring("before", -4, 4), F.lit("[0-9]")) | F.rlike(F.substring("after", 1, 4), F.lit("[0-9]")),
    }
    return rows.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()})


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_features(rows))


def mark_overlaps(rows: DataFrame) -> DataFrame:
    """Proposals that are no base span, with `free`: whether they overlap no base span of their text."""
    spans = rows.filter("base AND held").select("key", "start", "stop", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("match"),
                                              F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after"), F.lit(True).alias("fixed"))
    wide = rows.filter("NOT (base AND held)").select("key", "start", "stop", "kind", "match", "before", "after", F.lit(False).alias("fixed"))
    both = spans.unionByName(wide)
    order = Window.partitionBy("key").orderBy("start", F.desc("fixed"))
    behind = F.max(F.when(F.col("fixed"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min(F.when(F.col("fixed"), F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return both.withColumn("behind", behind).withColumn("ahead", ahead).filter("NOT fixed").select(
        "key", "start", "stop", "kind", "match", "before", "after",
        ((F.coalesce("behind", F.lit(-1)) <= F.col("start")) & (F.col("ahead").isNull() | (F.col("ahead") >= F.col("stop")))).alias("free"))


def examples_of(rows: DataFrame, wide: DataFrame) -> DataFrame:
    """kind, label, held_out and features of every example: base matches, the same in disguise, and free proposals."""
    plain = rows.filter("base AND held").select("key", "start", "kind", "match", "before", "after")
    hidden = F.col("match")
    for kind, (what, by) in DISGUISES.items():
        hidden = F.when(F.col("kind") == kind, F.regexp_replace("match", what, by)).otherwise(hidden)
    sorts = [(plain, 1.0), (plain.withColumn("match", hidden), 1.0), (wide.filter("free").select(*plain.columns), 0.0)]
    labelled = [frame.withColumn("label", F.lit(label)) for frame, label in sorts]
    held_out = F.pmod(F.xxhash64("start", "key"), F.lit(5)) == 0
    return with_features(labelled[0].unionByName(labelled[1]).unionByName(labelled[2])).select("kind", "label", held_out.alias("held_out"), *FEATURES)


def grouped(examples: DataFrame) -> DataFrame:
    """Equal examples as one row with their number `n`."""
    return examples.groupBy(*examples.columns).agg(F.count(F.lit(1)).cast("double").alias("n"))


def bins(rows: int) -> int:
    """So many bins that Spark ML takes the split points from all `rows` rows; with fewer it would draw a sample of them."""
    return LEAST_BINS if rows <= UNSAMPLED else max(LEAST_BINS, isqrt(rows - 1) + 1)


def train(rows: DataFrame, wide: DataFrame) -> tuple[GBTClassificationModel | None, dict[str, float]]:
    """Trees and the threshold of each kind; no trees without enough examples of both sides.

    A fifth of all proposals, by a hash of the text and the place, is held out for the thresholds; the others teach the trees.
    """
    examples = stored(grouped(examples_of(rows, wide)), "examples")
    sides = examples.groupBy("held_out", "label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    taught = {r["label"]: r for r in sides if not r["held_out"]}
    if len(taught) < 2 or min(r["n"] for r in taught.values()) < LEAST_POSITIVE:
        return None, {}
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(examples)
    trees = GBTClassifier(maxIter=20, maxDepth=4, seed=7, maxBins=bins(sum(r["rows"] for r in taught.values())), labelCol="label", featuresCol="features", weightCol="n")
    model = trees.fit(vectors.filter("NOT held_out"))
    judged = model.transform(vectors.filter("held_out")).select("kind", "label", "n", F.floor(vector_to_array("probability")[1] * 100).alias("level"))
    table = judged.groupBy("kind", "level").agg(F.sum(F.col("label") * F.col("n")).alias("yes"), F.sum("n").alias("n")).collect()  # at most 101 levels a kind
    limits = {}
    for kind in KINDS:
        yes = total = 0
        for level in sorted((r for r in table if r["kind"] == kind), key=lambda r: -r["level"]):
            yes, total = yes + level["yes"], total + level["n"]
            if yes >= LEAST_POSITIVE and yes >= PRECISION * total:
                limits[kind] = level["level"] / 100
    return model, limits


def select(wide: DataFrame, model: GBTClassificationModel | None, limits: dict[str, float]) -> DataFrame:
    """key, kind, start, stop of the proposals that pass; where they overlap, the one that starts first, then the longest, stays."""
    names = "key", "kind", "start", "stop"
    if model is None or not limits:
        return wide.filter("false").select(*names)
    limit = F.lit(2.0)
    for kind, value in limits.items():
        limit = F.when(F.col("kind") == kind, value).otherwise(limit)
    judged = model.transform(assembled(wide.filter("free")))
    passed = judged.filter(vector_to_array("probability")[1] >= limit).select(*names).distinct()
    before = Window.partitionBy("key").orderBy("start", F.desc("stop"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    return passed.withColumn("_m", F.max("stop").over(before)).filter("_m IS NULL OR _m <= start").select(*names)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """key (of the text, see `text_key`), kind, start, stop (code points, stop exclusive) and base of every span.

    Spans are found in whole texts, once for equal texts. A NULL or empty text has none. Base spans of different kinds may
    overlap; added ones overlap neither base spans nor each other. A kind without enough examples gets no added spans.
    """
    rows = proposals(docs, text)
    rows = stored(rows.withColumn("held", F.col("base") & holds(F.col("kind"), F.col("match"))), "proposals")
    wide = stored(mark_overlaps(rows), "wide")
    added = select(wide, *train(rows, wide)).withColumn("base", F.lit(False))
    return stored(rows.filter("base AND held").select("key", "kind", "start", "stop", "base").unionByName(added), "spans")


def spans_by_text(spans: DataFrame) -> DataFrame:
    """Per key the spans as an array in order of start, then kind; rank is the kind's place in KINDS."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    each = spans.withColumn("rank", rank)
    return each.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "stop", "kind", "base"))).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with each span in the text replaced by its kind in brackets, as [EMAIL]; overlapping spans become one, named
    for the first (of equal starts the longest, then the first kind by name). Other columns and the number of rows stay; a
    NULL text stays NULL."""
    spans = find(docs, text)
    order = Window.partitionBy("key").orderBy("start", F.desc("stop"))
    behind = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("_b") > F.col("start"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = spans.withColumn("_b", behind).withColumn("_i", island).groupBy("key", "_i").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("kind", F.struct("start", -F.col("stop"), "kind")).alias("kind"))
    after = F.lead("start").over(Window.partitionBy("key").orderBy("start"))
    pieces = merged.withColumn("until", after).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "until", "kind"))).alias("_spans"))
    whole = F.col(f"`{text}`")
    pieces = stored(pieces.withColumnRenamed("key", "_key"), "masks")
    keyed = docs.withColumn("_key", text_key(whole)).join(bounded(pieces, 80 + 60 * F.size("_spans")), "_key", "left")
    tail = lambda s: F.substring(whole, s["stop"] + 1, F.coalesce(s["until"], F.length(whole)) - s["stop"])
    made = F.concat(F.substring(whole, F.lit(1), F.col("_spans")[0]["start"]), F.array_join(F.transform(
        F.col("_spans"), lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"), tail(s))), ""))
    columns = [F.when(F.col("_spans").isNotNull(), made).otherwise(whole).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return keyed.select(*columns)
