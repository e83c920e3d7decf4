"""PII: candidate gradient boosting (operator 9).

Generators propose spans with high recall and little precision: e-mail addresses (also
spelt out), IP addresses, long digit groups, phone-like digit groups with and without a
country prefix, identity and account numbers.  Proposals may overlap.  Boosted trees score
each from its format (digits, groups, separators, check digits) and its context (cue words
before it, neighbouring characters).  Per kind, the probability above which at least
``precision`` of the kept-out training rows are right is the threshold; of overlapping
selected spans the likeliest stays.  Proposals that pass a kind's fixed test (the base
kinds) always stay.

The trees are trained here, on rows made from formats and carrier phrases, and become one
column expression, so the scan is one map over the texts with no shuffle.

Defined cases: null and empty texts have no spans; repeated rows are reported as they come;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.spans import listing, matches

# The base kinds with their fixed patterns, in the order of the report.  Look-behinds and
# possessive parts only keep the search linear and off the stack: they start a match where a
# leftmost match of the plain pattern starts, and nothing after them could be given back to.
BASE = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "spelt_email": r"(?i)\b[a-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[a-z0-9-]{1,63}\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[a-z]{2,10}\b",
    "local_phone": r"(?<![0-9+.)-])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "ip6": r"(?<![0-9A-Za-z:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![0-9A-Za-z:])",
    "dotted_card": r"(?<![0-9.])[0-9]{4}(?:[.\x20_-]{1,2}[0-9]{4}){3}(?![0-9.])",
}
NEEDS = {"email": "@", "phone": "+", "ip6": ":"}
CUES = (("mail", r"(?i)mail|contact|write|courriel|correo"), ("call", r"(?i)phone|tel|call|fax|mobile|ring|dial|handy|móvil"),
        ("pay", r"(?i)card|visa|master|credit|pay|karte|carte|tarjeta"),
        ("identity", r"(?i)ssn|social|security|passport|identity|ausweis|dni"), ("bank", r"(?i)iban|bank|account|konto|cuenta|compte"),
        ("host", r"(?i)\bip\b|host|server|address|adresse"),
        ("number", r"(?i)version|isbn|order|part|invoice|serial|model|page|ticket|tracking|build|release|article|\bno\b|#"))
LUHN_DIGITS = 40  # an account number has 34 at most
_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of 1 to ``LUHN_DIGITS`` digits passes the Luhn check; longer ones, which
    no number of this kind has, do not."""
    back = F.reverse(digits)

    def step(total, i):
        d = F.substring(back, i, 1).cast("int")
        return total + F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    return F.when(F.length(digits).between(1, LUHN_DIGITS), F.aggregate(places, F.lit(0), step) % 10 == 0).otherwise(F.lit(False))


def passes(kind: str, text: Column) -> Column:
    """The fixed test of a base kind."""
    n = F.length(digits_of(text))
    return {"email": F.lit(True), "ip": F.regexp_like(text, F.lit(_OCTETS)),
            "card": n.between(14, 19) & luhn(digits_of(text)), "phone": n.between(10, 15)}[kind]


FEATURES = ("kind", "chars", "digits", "letters", "separators", "groups", "distinct", "luhn", "octets", "first_zero", "alnum_before",
            "alnum_after", "sign_before", *(f"cue_{c}" for c, _ in CUES))


def features(kind: int, text: Column, before: Column, after: Column) -> Column:
    """Numbers the trees look at, in the order of FEATURES."""
    digits = digits_of(text)
    values = [F.lit(float(kind)), F.length(text), F.length(digits), F.length(F.regexp_replace(text, "[^A-Za-z]", "")),
              F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")), F.size(F.split(text, "[^A-Za-z0-9]+")),
              F.size(F.array_distinct(F.split(digits, ""))), F.when(luhn(digits), 1).otherwise(0),
              F.regexp_like(text, F.lit(_OCTETS)).cast("int"), digits.startswith("0").cast("int"),
              F.regexp_like(before, F.lit("[A-Za-z0-9]$")).cast("int"), F.regexp_like(after, F.lit("^[A-Za-z0-9]")).cast("int"),
              F.regexp_like(before, F.lit(r"[-.,/=#$_]$")).cast("int"),
              *[F.regexp_like(before, F.lit(p)).cast("int") for _, p in CUES]]
    return F.array(*[v.cast("double") for v in values])


def _teller(kind: str, rank: int):
    def tell(m):
        return F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
                        (passes(kind, m["text"]) if kind in BASE else F.lit(False)).alias("base"),
                        features(rank, m["text"], m["before"], m["after"]).alias("x"))
    return tell


def candidates(text: Column) -> Column:
    """Every proposed span (start, rank, end, kind, base, x): ``base`` if it passes the fixed
    test of a base kind, ``x`` its features."""
    parts = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        need = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else None
        found = matches(text, pattern, need)
        if kind == "card":  # shorter or longer digit groups are no kind of personal data here
            found = F.filter(found, lambda m: F.length(digits_of(m["text"])).between(13, 19))

        parts.append(F.transform(found, _teller(kind, rank)))
    return F.concat(*parts)


# ------------------------------------------------------------------ training rows

def _digits(r, n):
    return "".join(r.choice("0123456789") for _ in range(n))


def _luhn_number(r, n):
    body = r.choice("3456") + _digits(r, n - 2)
    total = sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(int(c) for c in reversed(body)))
    return body + str(-total % 10)


def _personal(r) -> tuple[str, str]:
    """(cue, value) of one piece of personal data."""
    name = "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randrange(3, 9)))
    kind = r.randrange(8)
    if kind == 0:
        return r.choice(["mail", "contact", "write to", ""]), f"{name}{r.choice(['', '.', '_'])}{_digits(r, r.randrange(3))}@{name[:4]}x.{r.choice(['com', 'org', 'de'])}"
    if kind == 1:
        return r.choice(["ip", "host", "from server", ""]), ".".join(str(r.randrange(1, 255)) for _ in range(4))
    if kind == 2:
        n = _luhn_number(r, 16)
        return r.choice(["card", "visa", "pay with", "credit card"]), r.choice(["", " ", "-", "."]).join(n[k:k + 4] for k in range(0, 16, 4))
    if kind == 3:
        return r.choice(["phone", "call", "tel", ""]), f"+{r.randrange(1, 99)} ({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}"
    if kind == 4:
        return r.choice(["mail", "contact", "write to"]), f"{name} {r.choice(['(at)', '[at]', 'at'])} {name[:5]}{r.choice([' (dot) ', ' [dot] ', ' dot '])}com"
    if kind == 5:
        area = r.choice(["({}) ", "{}-", "{}.", "{} "]).format(_digits(r, 3))
        return r.choice(["phone", "call", "tel", "fax", "mobile"]), f"{area}{_digits(r, 3)}{r.choice('-. ')}{_digits(r, 4)}"
    if kind == 6:
        return r.choice(["ssn", "social security", "passport"]), f"{_digits(r, 3)}-{_digits(r, 2)}-{_digits(r, 4)}"
    if r.random() < 0.3:
        return r.choice(["ip", "host", "server"]), ":".join(f"{r.randrange(65536):x}" for _ in range(8))
    body = _digits(r, 18)
    return r.choice(["iban", "bank account", "konto"]), f"{r.choice(['DE', 'FR', 'ES'])}{body[:2]} " + " ".join(body[k:k + 4] for k in range(2, 18, 4))


def _impersonal(r) -> tuple[str, str]:
    """(cue, value) of something that only looks like it."""
    kind = r.randrange(7)
    if kind == 0:
        return r.choice(["version", "release", "build"]), ".".join(str(r.randrange(900)) for _ in range(4))
    if kind == 1:
        return r.choice(["order", "tracking no", "serial"]), _digits(r, r.randrange(13, 20))
    if kind == 2:
        return r.choice(["part", "model", "article", "page"]), f"{_digits(r, 3)}-{_digits(r, 2)}-{_digits(r, 4)}"
    if kind == 3:
        return r.choice(["isbn", "invoice", "ticket", "part"]), f"{_digits(r, 3)}{r.choice('-. ')}{_digits(r, 3)}{r.choice('-. ')}{_digits(r, 4)}"
    if kind == 4:
        return r.choice(["look", "we met", "sit"]), r.choice(["him at home dot it", "them at noon dot so", "me at work dot then"])
    if kind == 5:
        return r.choice(["serial", "model", "part"]), f"{r.choice(['AB', 'QX', 'ZZ'])}{_digits(r, 2)} " + " ".join(
            "".join(r.choice("ABCDEFGH0123456789") for _ in range(4)) for _ in range(4))
    n = _digits(r, 16)
    return r.choice(["tracking", "order", "serial"]), r.choice(".-_ ").join(n[k:k + 4] for k in range(0, 16, 4))


def examples(rows: int = 3000, seed: int = 9) -> list[tuple[int, str, int]]:
    """(fold, text, label): one piece each, inside prose."""
    r = random.Random(seed)
    def prose():
        return " ".join("".join(r.choice("aeiounrst") for _ in range(r.randrange(2, 7))) for _ in range(r.randrange(3, 9)))
    out = []
    for i in range(rows):
        label = int(r.random() < 0.5)
        cue, value = _personal(r) if label else _impersonal(r)
        out.append((i % 3, f"{prose()} {cue} {value} {prose()}", label))
    return out


def fit(spark: SparkSession, rows: list[tuple[int, str, int]] | None = None, trees: int = 12, depth: int = 4,
        precision: float = 0.97) -> dict:
    """Boosted trees and, per kind, the calibrated threshold (above 1: never selected).

    ``rows``: (fold, text, label); fold 2 is kept out for the thresholds.
    """
    data = spark.createDataFrame(rows or examples(), "fold int, text string, label int").coalesce(1)
    made = data.select("fold", F.col("label").cast("double").alias("label"), F.explode(candidates(F.col("text"))).alias("c")).select(
        "fold", "label", F.col("c.kind").alias("kind"), array_to_vector("c.x").alias("features"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=5).fit(made.where("fold < 2"))
    # bounded by the training rows
    held = [(r["kind"], r["p"], r["label"]) for r in model.transform(made.where("fold = 2")).select(
        "kind", "label", vector_to_array("probability")[1].alias("p")).collect()]
    thresholds = {}
    for kind in PATTERNS:
        own = sorted(((p, y) for k, p, y in held if k == kind), reverse=True)
        right = best = 0
        limit = 2.0
        for n, (p, y) in enumerate(own, 1):
            right += y
            if right >= precision * n and n > best and (n == len(own) or own[n][0] < p):
                best, limit = n, p
        thresholds[kind] = max(limit, 0.5)
    java = model._java_obj
    roots = [t.rootNode() for t in java.trees()]
    return {"trees": [(float(w), _nested(root)) for w, root in zip(java.treeWeights(), roots, strict=True)], "thresholds": thresholds}


def _nested(node):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _nested(node.leftChild()), _nested(node.rightChild()))


def _tree(node, x: Column) -> Column:
    if isinstance(node, float):
        return F.lit(node)
    index, threshold, left, right = node
    return F.when(x[index] <= threshold, _tree(left, x)).otherwise(_tree(right, x))


def probability(model: dict, x: Column) -> Column:
    """The boosted trees as one expression."""
    total = F.lit(0.0)
    for weight, root in model["trees"]:
        total = total + weight * _tree(root, x)
    return 1 / (1 + F.exp(-2 * total))


def scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """(doc_id, spans) per document row: the base spans and those the trees add, each
    (start, rank, end, kind, base, probability)."""
    model = model or fit(docs.sparkSession)
    limits = F.array(*[F.lit(float(model["thresholds"][k])) for k in PATTERNS])
    proposed = docs.select("doc_id", candidates(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("c"))
    scored = proposed.select("doc_id", F.transform("c", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"),
        F.round(probability(model, s["x"]), 6).alias("probability"))).alias("c"))
    chosen = scored.select("doc_id", F.filter("c", lambda s: s["base"] | (s["probability"] >= F.element_at(limits, s["rank"] + 1))).alias("c"))

    def free(s, group):  # no base span and no likelier (then earlier, then lower-ranked) choice overlaps
        def beats(o):
            over = (o["start"] < s["end"]) & (s["start"] < o["end"])
            order = F.struct((~o["base"]).alias("b"), (-o["probability"]).alias("p"), o["start"].alias("s"), o["rank"].alias("r"))
            mine = F.struct((~s["base"]).alias("b"), (-s["probability"]).alias("p"), s["start"].alias("s"), s["rank"].alias("r"))
            return over & (order < mine)
        return s["base"] | ~F.exists(group, beats)

    extra = F.exists("c", lambda s: ~s["base"])
    groups = _overlapping(F.array_sort("c"))
    settled = F.flatten(F.transform(groups, lambda g: F.filter(g, lambda s: free(s, g))))
    return chosen.select("doc_id", F.when(extra, settled).otherwise(F.col("c")).alias("spans"))


_SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,base:boolean,probability:double>"


def _overlapping(spans: Column) -> Column:
    """Spans sorted by start, in groups none of which overlaps another.  Finished groups are put
    away by the hundred, since appending copies an array."""
    empty = F.expr(f"named_struct('far', cast(array() as array<array<array<{_SPAN}>>>), 'near', cast(array() as array<array<{_SPAN}>>), "
                   f"'group', cast(array() as array<{_SPAN}>), 'reach', -1L)")

    def step(acc, s):
        joins = s["start"] < acc["reach"]
        put = ~joins & (F.size(acc["near"]) >= 100)
        near = F.when(joins, acc["near"]).when(put, F.array(acc["group"])).otherwise(F.concat(acc["near"], F.array(acc["group"])))
        return F.struct(F.when(put, F.concat(acc["far"], F.array(acc["near"]))).otherwise(acc["far"]).alias("far"), near.alias("near"),
                        F.when(joins, F.concat(acc["group"], F.array(s))).otherwise(F.array(s)).alias("group"),
                        F.greatest(acc["reach"], s["end"]).alias("reach"))

    return F.aggregate(spans, empty, step, lambda acc: F.concat(F.flatten(acc["far"]), acc["near"], F.array(acc["group"])))


def report(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and listing of all spans per document row."""
    base = F.filter("spans", lambda s: s["base"])
    def of(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(of, BASE), F.sha2(listing(base), 256).alias("base_sha256"),
                        listing(F.col("spans")).alias("spans"))
