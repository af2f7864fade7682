"""Personal data by boosted candidates, in DataFrame functions only.

Four base rules give spans that always stay. Wider generators propose further, overlapping spans (addresses without a domain ending, numbers with
other separators, secrets); boosted trees score each by its format and context, and a threshold for each kind selects those to add. The candidates of all
documents are counted by equal feature rows, with the checked rules as labels. The trees are fitted on the driver to a bounded number of these rows
for each kind (all rows of a rare kind) and are applied as one SQL expression. Thresholds are set on the counts of every fourth document, which are
kept from the fit, so that the selected spans are right in 99 of 100 cases. A kind without such a threshold adds the candidates that pass its own check.

Java's patterns below find what the plain rules find, without retries: a possessive run starts only where its class starts or the last match ended.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.boosting import Trees, fit
from studyflow.llm.shared import documents
from studyflow.session import staged

BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?:(?<![^\s@<>()\[\],;\"'])|\G)[^\s@<>()\[\],;\"']++(?:@|\[at\])[^\s@<>()\[\],;\"']++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:[.,:-][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ./_-]?[0-9]{3,6}){2,4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,5}(?![0-9])",
    "secret": r"(?i)(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[:=][ ]?[\"']?[A-Za-z0-9+/_.-]{6,}+",
}
# What a text must hold for a pattern to be tried at all.
NEEDED = {"email": "[@\\[]", "ip": "[0-9]", "card": "[0-9]{2}", "phone": "[0-9]{2}", "secret": "[:=]"}
KINDS = [*BASE, "secret"]
CUES = r"(?i)(?:mail|phone|tel|call|mobile|fax|card|visa|credit|account|host|server|address|pass|token|key|secret)[^A-Za-z]{0,4}[A-Za-z]{0,8}[^A-Za-z]{0,4}$"
FEATURES = ["kind", "length", "digits", "letters", "separators", "dots", "plus", "at", "luhn", "octets", "ending", "left", "right", "cue", "mixed"]

# Distinct feature rows of a kind that the trees are fitted to, on average; a kind with fewer gives all.
SAMPLE = 2_000
RIGHT = 0.99
# Wrong candidates that every threshold counts beside those it saw: a kind with few right ones stays with its own check.
DOUBT = 0.08
# Thresholds lie on a grid of the log-odds: GRID steps to one, up to FAR on both sides.
GRID, FAR = 64, 30
CHUNK = 256
# Code points of the pieces that a text is cut into for its redaction.
PIECE = 1024


def located(steps: Column) -> Column:
    """Array of (start, end, found, left, right) from (gap, size, found, left, right); positions count code points.

    Prefix sums over CHUNK steps at a time: an array that grows by one is copied each time, so long ones are put together from short ones.
    """
    chunks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int"))
    part = lambda c: F.slice(steps, c * CHUNK + 1, F.lit(CHUNK))
    sums = F.transform(chunks, lambda c: F.aggregate(part(c), F.lit(0), lambda acc, x: acc + x["gap"] + x["size"]))
    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
    begins = F.aggregate(sums, first, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        row = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found"), x["left"].alias("left"), x["right"].alias("right"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    empty = F.expr("cast(array() as array<struct<start:int,end:int,found:string,left:string,right:string>>)")
    parts = F.transform(begins, lambda at, c: F.aggregate(part(c), F.struct(at.alias("at"), empty.alias("out")), step, lambda acc: acc["out"]))
    return F.when(F.size(steps) > 0, F.flatten(parts)).otherwise(empty)


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def octets(found: Column) -> Column:
    return F.forall(F.split(found, r"[.,:-]"), lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)


def luhn(found: Column) -> Column:
    d = digits(found)
    return F.when(F.length(d).between(12, 19), F.call_function("luhn_check", d)).otherwise(F.lit(False))


def holds(kind: str, found: Column) -> Column:
    """The check of a base rule."""
    return {"email": lambda: F.lit(True), "ip": lambda: octets(found), "card": lambda: luhn(found), "phone": lambda: F.length(digits(found)).between(9, 15)}[kind]()


def with_matches(df: DataFrame, patterns: dict[str, str], prefix: str) -> DataFrame:
    """Array columns ``prefix`` + kind of (start, end, found, left, right) in the column __text; left and right are what stands between this match and its neighbours, 24 and 1 characters at most."""
    text, none = F.col("__text"), F.array().cast("array<string>")
    cols = {}
    for kind, pattern in patterns.items():
        tried = F.col("__text").rlike(NEEDED[kind])
        cols[f"__hits_{kind}"] = F.when(tried, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    df = df.withColumns(cols)
    gaps = {f"__gaps_{k}": F.when(F.size(f"__hits_{k}") > 0, F.split(text, p, -1)).otherwise(none) for k, p in patterns.items()}
    df = df.withColumns(gaps)

    def described(kind: str):
        gap = lambda i: F.get(f"__gaps_{kind}", i)
        return lambda hit, i: F.struct(F.char_length(gap(i)).alias("gap"), F.char_length(hit).alias("size"), hit.alias("found"), F.substring(gap(i), -24, 24).alias("left"), F.substring(gap(i + 1), 1, 1).alias("right"))

    steps = {f"__steps_{k}": F.transform(f"__hits_{k}", described(k)) for k in patterns}
    df = df.withColumns(steps).drop(*cols, *gaps)
    return df.withColumns({f"{prefix}{k}": located(F.col(f"__steps_{k}")) for k in patterns}).drop(*steps)


def kind_of(char: Column) -> Column:
    return F.when(char.rlike("[0-9]"), 3).when(char.rlike("[A-Za-z]"), 2).when(char.rlike(r"\S"), 1).otherwise(0)


def format_and_context(kind: str, x: Column) -> Column:
    """Array of the features of one candidate."""
    found = x["found"]
    d = F.length(digits(found))
    values = {
        "kind": F.lit(KINDS.index(kind)), "length": F.char_length(found), "digits": d, "letters": F.length(F.regexp_replace(found, "[^A-Za-z]", "")), "separators": F.length(F.regexp_replace(found, "[^ ,:/_-]", "")),
        "dots": F.length(F.regexp_replace(found, "[^.]", "")), "plus": found.startswith("+"), "at": found.contains("@"), "luhn": luhn(found), "octets": octets(found), "ending": found.rlike(r"\.[A-Za-z]{2,12}[.]?$"),
        "left": kind_of(F.substring(x["left"], -1, 1)), "right": kind_of(x["right"]),
        "cue": x["left"].rlike(CUES) if kind != "secret" else F.lit(True),
        "mixed": found.rlike("[:=].*[0-9]") & found.rlike("[:=].*[A-Za-z]"),
    }
    return F.array(*[values[f].cast("int") for f in FEATURES])


def checked(kind: str, x: Column) -> Column:
    """The label of a candidate: the rule of its kind holds for the whole of it."""
    found = x["found"]
    if kind == "secret":
        return found.rlike("[:=].*[0-9]") & (F.char_length(F.regexp_replace(found, "^.*[:=]", "")) >= 8)
    rule = {"email": BASE["email"], "ip": BASE["ip"], "card": BASE["card"], "phone": BASE["phone"]}[kind]
    return found.rlike(f"^(?:{rule})$") & holds(kind, found)


def candidates(df: DataFrame) -> DataFrame:
    """Column __candidates: (kind, start, end, features, label) of all wide spans in the column __text."""
    df = with_matches(df, WIDE, "__wide_")

    def described(kind: str):
        return lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), format_and_context(kind, x).alias("features"), checked(kind, x).alias("label"))

    return df.withColumn("__candidates", F.concat(*[F.transform(f"__wide_{k}", described(k)) for k in WIDE])).drop(*[f"__wide_{k}" for k in WIDE])


class Selector:
    """Trees and, for each kind, the least log-odds of a span to add (none: the kind adds what passes its own check)."""

    def __init__(self, trees: Trees, least: dict[str, float]):
        self.trees, self.least = trees, least

    def margin(self, features: Column) -> Column:
        def node(tree: int, at: int, depth: int) -> Column:
            if depth == 0:
                return F.lit(float(self.trees.value[tree, at]))
            if not np.isfinite(self.trees.threshold[tree, at]):
                return node(tree, 2 * at + 1, depth - 1)
            test = features[int(self.trees.feature[tree, at])] > float(self.trees.threshold[tree, at])
            return F.when(test, node(tree, 2 * at + 2, depth - 1)).otherwise(node(tree, 2 * at + 1, depth - 1))

        total = F.lit(self.trees.base)
        for tree in range(len(self.trees.feature)):
            total = total + node(tree, 0, self.trees.depth)
        return total

    def selects(self, candidate: Column) -> Column:
        """By the trees for a kind with a threshold, else by the kind's own check."""
        limit = F.lit(None).cast("double")
        for kind, least in self.least.items():
            limit = F.when(candidate["kind"] == kind, least).otherwise(limit)
        if not self.least:
            return candidate["label"]
        return F.coalesce(self.margin(candidate["features"]) >= limit, candidate["label"])


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """kept_out, x, y and n: how many candidates of all documents have the features x and the label y, apart for every fourth document."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("__text"), (F.pmod(F.shiftright(F.xxhash64(F.col(id_col)), 20), F.lit(4)) == 0).alias("kept_out"))
    # An outer explode: for an inner one the optimizer would compute all candidates once more to test that there are some.
    found = candidates(texts).select("kept_out", F.explode_outer("__candidates").alias("c")).where("c is not null")
    return found.groupBy("kept_out", F.col("c.features").alias("x"), F.col("c.label").alias("y")).agg(F.count(F.lit(1)).alias("n"))


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Selector:
    """Count the candidates of all documents once, fit on a bounded number of feature rows and set the thresholds on all counts kept from the fit."""
    rows = staged(counted(docs, id_col, text_col), "candidates")
    fitted, kind = rows.where("not kept_out"), F.get("x", 0)
    share = {r["kind"]: min(1.0, sample / r["n"]) for r in fitted.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = F.lit(0)
    for k, part in share.items():
        limit = F.when(kind == k, round(part * 2**20)).otherwise(limit)
    found = fitted.where(F.pmod(F.xxhash64("x"), F.lit(2**20)) < limit).select("x", "y", "n").collect()
    found.sort(key=lambda r: (r["x"], r["y"]))
    x = np.array([r["x"] for r in found], float).reshape(-1, len(FEATURES))
    y, times = np.array([bool(r["y"]) for r in found], float), np.minimum(np.array([r["n"] for r in found], int), 200)
    trees = fit(np.repeat(x, times, axis=0), np.repeat(y, times), trees=24, depth=3, rate=0.3, least=4)
    return Selector(trees, thresholds(rows.where("kept_out"), Selector(trees, {})))


def thresholds(rows: DataFrame, selector: Selector) -> dict[str, float]:
    """For each kind the least log-odds above which RIGHT of the candidates counted in ``rows`` (x, y, n) and of DOUBT more are right.

    Counts for each step of the grid reach the driver, a bounded number whatever the number of rows.
    """
    step = F.floor(F.greatest(F.lit(-float(FAR)), F.least(F.lit(float(FAR)), selector.margin(F.col("x")))) * GRID)
    counts = rows.select(F.get("x", 0).alias("kind"), step.alias("step"), "y", "n").groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)).alias("right")).collect()
    least = {}
    for k, kind in enumerate(KINDS):
        right = total = 0
        for r in sorted((r for r in counts if r["kind"] == k), key=lambda r: -r["step"]):
            right, total = right + r["right"], total + r["n"]
            if right and right >= RIGHT * (total + DOUBT):
                least[kind] = r["step"] / GRID if r["step"] > -FAR * GRID else float("-inf")
    return least


def with_spans(docs: DataFrame, selector: Selector, text_col: str = "text") -> DataFrame:
    """``docs`` with __base and __spans: sorted arrays of (start, end, kind), each span once; a null text has none."""
    df = with_matches(docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))), BASE, "__base_")

    def right(kind: str):
        return lambda x: holds(kind, x["found"])

    # Spans are sorted and made distinct as texts of fixed width, start, kind and end.
    width = 12

    def key(start: Column, rank: Column, end: Column) -> Column:
        return F.concat(F.lpad(start.cast("string"), width, "0"), rank.cast("string"), F.lpad(end.cast("string"), width, "0"))

    def shown(kind: str):
        return lambda x: key(x["start"], F.lit(KINDS.index(kind)), x["end"])

    base = [F.transform(F.filter(f"__base_{k}", right(k)), shown(k)) for k in BASE]
    df = candidates(df.withColumn("__base", F.concat(*base)).drop(*[f"__base_{k}" for k in BASE]))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    added = F.transform(F.filter("__candidates", selector.selects), lambda c: key(c["start"], F.array_position(kinds, c["kind"]) - 1, c["end"]))

    def read(keys: Column) -> Column:
        return F.transform(F.array_sort(F.array_distinct(keys)), lambda k: F.struct(
            F.substring(k, 1, width).cast("int").alias("start"), F.substring(k, width + 2, width).cast("int").alias("end"), F.get(kinds, F.substring(k, width + 1, 1).cast("int")).alias("kind")))

    return df.withColumns({"__base": read(F.col("__base")), "__spans": read(F.concat("__base", added))}).drop("__candidates", "__text")


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def is_kind(kind: str):
    return lambda found: found == kind


def report(docs: DataFrame, selector: Selector) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest and all spans; one row for each row."""
    df = with_spans(docs.select("doc_id", "text"), selector)
    counts = [F.size(F.filter(F.transform("__base", lambda s: s["kind"]), is_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return df.select("doc_id", *counts, F.sha2(joined("__base"), 256).alias("base_sha256"), joined("__spans").alias("spans"))


def reached(spans: Column) -> Column:
    """For each span the greatest end of the earlier ones (0 for the first), put together from CHUNK spans at a time as in ``located``."""
    chunks = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / CHUNK).cast("int"))
    part = lambda c: F.slice(spans, c * CHUNK + 1, F.lit(CHUNK))
    ends = F.transform(chunks, lambda c: F.array_max(F.transform(part(c), lambda s: s["end"])))
    empty = F.expr("cast(array() as array<int>)")
    grow = lambda acc, end: F.struct(F.greatest(acc["at"], end).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    begins = F.aggregate(ends, F.struct(F.lit(0).alias("at"), empty.alias("out")), grow, lambda acc: acc["out"])
    parts = F.transform(begins, lambda at, c: F.aggregate(part(c), F.struct(at.alias("at"), empty.alias("out")), lambda acc, s: grow(acc, s["end"]), lambda acc: acc["out"]))
    return F.when(F.size(spans) > 0, F.flatten(parts)).otherwise(empty)


def between(pieces: Column, low: Column, high: Column) -> Column:
    """The code points from ``low`` up to ``high`` of a text that was cut into pieces of PIECE."""
    first, last = F.floor(low / PIECE).cast("int"), F.floor((high - 1) / PIECE).cast("int")
    piece = lambda k: F.get(pieces, k)
    one = F.substring(piece(first), low - first * PIECE + 1, high - low)
    several = F.concat(F.substring(piece(first), low - first * PIECE + 1, F.lit(PIECE)), F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substring(piece(last), F.lit(1), high - last * PIECE))
    return F.when(high <= low, "").when(first == last, one).otherwise(several)


def redacted(docs: DataFrame, selector: Selector, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; spans that overlap become one, of the first one's kind. Null texts stay null. n_chars, if there, follows."""
    text = F.col(text_col)
    df = with_spans(docs, selector, text_col)
    found = F.size("__spans") > 0
    # The text is cut into pieces once, so that a span in the middle is not looked up from the beginning.
    pieces = F.when(found, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    df = df.withColumns({"__pieces": pieces, "__reached": reached(F.col("__spans"))})

    def part(s: Column, i: Column) -> Column:
        before = F.get("__reached", i)
        return F.when(s["start"] >= before, F.concat(between(F.col("__pieces"), before, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

    last = F.array_max(F.transform("__spans", lambda s: s["end"]))
    whole = F.concat(F.array_join(F.transform("__spans", part), ""), between(F.col("__pieces"), last, F.char_length(text)))
    df = df.withColumn("__text", F.when(text.isNull() | ~found, text).otherwise(whole))
    new = {text_col: F.col("__text")} | ({"n_chars": F.char_length("__text").cast("long")} if "n_chars" in docs.columns else {})
    return df.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return report(docs, train(docs))
