"""PII: candidate spans, boosted trees over format and context, redaction.

Generators propose spans, also overlapping ones.  The four base kinds have
fixed patterns and checks, and their valid matches always count.  The other
candidates, among them base matches that fail their check and long runs of
letters and digits, are scored by gradient-boosted trees on their format and
context; each kind has a threshold, calibrated on candidates that the fit has
not seen, and what scores above it is added.  No labels of personal data are
given: the fit learns from the checks and from naming words before a span, in
all documents.

Only DataFrame and SQL functions run.  The trees become SQL expressions, so
documents are read once for the fit and once for the spans, without a shuffle.

Defined results: a null or empty text has no spans; a null id is kept; rows
that repeat an id are judged each; without candidates of both outcomes
nothing is added; offsets are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strobe.llm.shared import materialise

#: Fixed values of the base kinds, in their order.  The quantifiers give
#: nothing back and a run is entered at its start or after a match only, which
#: finds the same spans in linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kinds that only the trees can accept.
MORE_PATTERNS = {"secret": r"(?<![0-9A-Za-z])[0-9A-Za-z_/+-]{24,}+"}
#: Characters without which a kind cannot occur.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
NAMING = r"(?i)(?:token|secret|password|passwd|api.?key|bearer)\W{0,6}$"
KINDS = [*PATTERNS, *MORE_PATTERNS]

#: Settings of the fit.
TREES, DEPTH = 10, 4
PRECISION = 0.995
CONTEXT = 24

FEATURES = [
    "kind", "chars", "digits", "letters", "uppers", "others", "groups", "longest_gap", "luhn",
    "before_space", "before_letter", "before_sign", "after_space", "after_letter", "named", "mixed",
]


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("double")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    terms = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
            F.when(d.try_cast("int") > 4, d.try_cast("int") * 2 - 9).otherwise(d.try_cast("int") * 2)
        ),
    )
    return F.aggregate(terms, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def check(kind: str, value: Column) -> Column:
    """The base kinds' check of a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(bare(p)) <= 3) & (F.coalesce(F.substring(bare(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(_digits(value))).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(False)


#: Columns that are added to those of the documents.
BASE, OPEN, ADDED, MATCHES = "__pii_base", "__pii_open", "__pii_added", "__pii_matches"
SPAN = "struct<kind:int,start:bigint,end:bigint,value:string>"


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Spans of the leftmost non-overlapping matches of a pattern."""
    number = KINDS.index(kind)
    parts = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).cast("long").alias("gap"), value.alias("value")),
    )
    placed = F.aggregate(
        parts,
        F.struct(F.array().cast(f"array<{SPAN}>").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda s, p: F.struct(
            F.when(p["value"].isNull(), s["out"]).otherwise(
                F.concat(
                    s["out"],
                    F.array(
                        F.struct(
                            F.lit(number).alias("kind"), (s["at"] + p["gap"]).alias("start"),
                            (s["at"] + p["gap"] + F.length(p["value"])).alias("end"), p["value"].alias("value"),
                        )
                    ),
                )
            ).alias("out"),
            (s["at"] + p["gap"] + F.coalesce(F.length(p["value"]), F.lit(0))).alias("at"),
        ),
        lambda s: s["out"],
    )
    found = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.rlike(text, F.lit(pattern))
    return F.when(found, placed).otherwise(F.array().cast(f"array<{SPAN}>"))


def candidates(docs: DataFrame) -> DataFrame:
    """docs with BASE (valid spans of the base kinds) and OPEN (other
    candidates, none inside a base span)."""
    text = F.coalesce("text", F.lit(""))
    out = docs.withColumns({f"{MATCHES}{i}": matches(text, kind, p) for i, (kind, p) in enumerate((PATTERNS | MORE_PATTERNS).items())})
    passes = lambda kind: lambda m: check(kind, m["value"])
    fails = lambda kind: lambda m: ~check(kind, m["value"])
    valid = [F.filter(f"{MATCHES}{i}", passes(kind)) for i, kind in enumerate(PATTERNS)]
    out = out.withColumn(BASE, F.concat(*valid))
    failed = [F.filter(f"{MATCHES}{i}", fails(kind)) for i, kind in enumerate(KINDS)]
    free = lambda m: ~F.exists(BASE, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    out = out.withColumn(OPEN, F.filter(F.concat(*failed), free))
    return out.drop(*(f"{MATCHES}{i}" for i in range(len(KINDS))))


def features(text: Column, m: Column) -> Column:
    """Format and context of a span, in the order of FEATURES."""
    value = m["value"]
    before = F.substring(text, F.greatest(m["start"] - CONTEXT + 1, F.lit(1)).cast("int"), F.least(m["start"], F.lit(CONTEXT)).cast("int"))
    after = F.substring(text, (m["end"] + 1).cast("int"), F.lit(1))
    flag = lambda c: c.cast("double")
    digits = F.substring(_digits(value), 1, 40)
    return F.array(
        m["kind"].cast("double"), F.length(value).cast("double"), _count(value, "[^0-9]"), _count(value, "[^A-Za-z]"),
        _count(value, "[^A-Z]"), _count(value, "[0-9A-Za-z]"), F.size(F.split(value, r"[^0-9A-Za-z]+")).cast("double"),
        F.array_max(F.transform(F.split(value, "[0-9]+"), lambda g: F.length(g))).cast("double"), flag(luhn(digits)),
        flag(F.rlike(before, F.lit(r"(?:^|\s)$"))), flag(F.rlike(before, F.lit(r"\p{L}$"))), flag(F.rlike(before, F.lit(r"[=:\"'#]\s?$"))),
        flag(F.rlike(after, F.lit(r"^(?:\s|$)"))), flag(F.rlike(after, F.lit(r"^\p{L}"))), flag(F.rlike(before, F.lit(NAMING))),
        flag(F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))),
    )


@dataclass
class Trees:
    """Boosted trees as nested (feature, threshold, left, right) or leaves,
    their weights, and the score from which on each kind's spans count."""

    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, x: Column) -> Column:
        """Probability of a feature array, as a SQL expression."""

        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, threshold, left, right = node
            return F.when(F.get(x, F.lit(feature)) <= threshold, value(left)).otherwise(value(right))

        margin = F.lit(0.0)
        for weight, tree in zip(self.weights, self.trees, strict=True):
            margin = margin + F.lit(weight) * value(tree)
        return 1 / (1 + F.exp(-2 * margin))

    def accepted(self, kind: Column, score: Column) -> Column:
        out = F.lit(False)
        for k, threshold in self.thresholds.items():
            out = F.when(kind == k, score >= threshold).otherwise(out)
        return out


def _node(node) -> tuple | float:
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    split = node.split()
    return split.featureIndex(), split.threshold(), _node(node.leftChild()), _node(node.rightChild())


def fit_trees(docs: DataFrame) -> Trees:
    """Fit on the candidates of all documents; those of a fifth of the
    documents calibrate the thresholds."""
    text = F.coalesce("text", F.lit(""))
    every = candidates(docs.select("doc_id", "text")).select("doc_id", text.alias("text"), F.explode(F.concat(
        F.transform(BASE, lambda m: F.struct(m.alias("m"), F.lit(1.0).alias("label"))),
        F.transform(OPEN, lambda m: F.struct(m.alias("m"), F.lit(0.0).alias("label"))),
    )).alias("c"))
    x = every.select("doc_id", "c.m.kind", "c.label", features(F.col("text"), F.col("c.m")).alias("x"))
    number = {f: i for i, f in enumerate(FEATURES)}
    # of kinds without a check, naming words tell
    mark = F.when(F.col("kind") < len(PATTERNS), F.col("label")).otherwise(F.get("x", F.lit(number["named"])) * F.get("x", F.lit(number["mixed"])))
    rows = materialise(
        x.select("kind", mark.alias("label"), (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 0).alias("test"), *(F.get("x", F.lit(i)).alias(f"x{i}") for i in range(len(FEATURES)))),
        "pii-candidates",
    )
    learn = rows.where("not test")
    ends = learn.agg(F.min("label").alias("least"), F.max("label").alias("most")).collect()[0]
    if ends.least == ends.most:
        return Trees()
    columns = [f"x{i}" for i in range(len(FEATURES))]
    gbt = GBTClassifier(labelCol="label", featuresCol="v", maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=5)
    model = gbt.fit(VectorAssembler(inputCols=columns, outputCol="v").transform(learn).select("label", "v"))
    out = Trees([_node(t._java_obj.rootNode()) for t in model.trees], list(model.treeWeights))
    # the smallest score above which a kind's candidates are right often enough
    scored = rows.where("test").select("kind", "label", F.round(out.score(F.array(*columns)), 3).alias("score"))
    points = scored.groupBy("kind", "score").agg(F.sum("label").alias("hits"), F.count("*").alias("n")).collect()
    seen: dict[int, list[float]] = {}
    for p in sorted(points, key=lambda p: (p.kind, -p.score)):
        own = seen.setdefault(p.kind, [0.0, 0.0])
        own[0], own[1] = own[0] + p.hits, own[1] + p.n
        if own[0] >= PRECISION * own[1] and p.score >= 0.5:
            out.thresholds[p.kind] = p.score - 0.0005
    return out


def find_spans(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs with BASE and ADDED spans."""
    text = F.coalesce("text", F.lit(""))
    found = candidates(docs)
    scored = F.transform(OPEN, lambda m: F.struct(m.alias("m"), features(text, m).alias("x")))
    found = found.withColumn(OPEN, F.when(F.size(OPEN) > 0, scored))
    kept = F.filter(OPEN, lambda c: trees.accepted(c["m"]["kind"], trees.score(c["x"])))
    return found.withColumn(ADDED, F.coalesce(F.transform(kept, lambda c: c["m"]), F.array().cast(f"array<{SPAN}>"))).drop(OPEN)


def span_list(spans: Column) -> Column:
    """kind:start:end, by kind as listed, then start, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, or each overlap of spans, replaced by the kind
    of its first."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    step = lambda a, s: F.when(
        s["start"] >= a["at"],
        F.struct(
            F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.get(names, s["kind"])).alias("out"),
            s["end"].alias("at"),
        ),
    ).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate(ordered, start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs with their columns, the text redacted (n_chars counted anew)."""
    found = find_spans(docs, trees)
    out = found.withColumn("text", redact(F.col("text"), F.concat(BASE, ADDED))).drop(BASE, ADDED)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)
