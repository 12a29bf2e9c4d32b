"""Personal data by weak supervision (operator 8).

Patterns propose candidates: e-mail, IP, card and phone shapes (the *base*
kinds, with their checks), digit strings that only look like a card, quoted
tokens, and capitalised words in pairs after a form of address or a known
given name.  Five labelers vote on each candidate (for, against, or not at
all): its shape, a gazetteer, the words before it, its neighbours, and the
variety of its characters.  Expectation-maximisation estimates how reliable
each labeler is and how likely each pattern of votes is personal data; a
logistic span classifier is trained on these likelihoods, over votes, kind
and length.  Candidates that pass the base checks always stay; of the others
those that the classifier accepts are added, under kinds of their own.

Rows only meet DataFrame functions.  The model is fitted on counts of vote
patterns over all documents, which Spark sums; there are at most
``kinds x 3^5 x lengths`` of them, whatever the data's size.  Texts don't
shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

#: Kinds in the order that breaks ties between spans of the same start.
KINDS = ("email", "ip", "card", "phone", "number", "token", "person")
BASE = 4
#: Given names and forms of address that the person pattern starts from; a parameter in all but place.
NAMES = ("Anna", "Carlos", "David", "Elena", "Emma", "Hans", "James", "Jean", "John", "Juan", "Klaus", "Laura", "Lucia", "Maria",
         "Marie", "Mary", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sarah", "Sophie", "Thomas")
TITLES = ("Dr", "Frau", "Herr", "Madame", "Monsieur", "Mr", "Mrs", "Ms", "Prof", "Señor", "Señora")
#: Values that stand in for data: local hosts, example domains, counting and round numbers.
PLACEHOLDERS = r"^(?:127\.0\.0\.1|0\.0\.0\.0|255\.255\.255\.255|[0 -]+|1234567890\d*|.*@(?:localhost|test)\..*)$"
CUES_FOR = (r"(?i)(?:e-?mail|mail|correo|courriel|contact|kontakt|contacto|call|phone|tel|telefon|téléphone|teléfono|mobile|fax|card|carte|"
            r"karte|tarjeta|visa|iban|konto|compte|cuenta|ssn|passport|ip|host|server|address|adresse|token|key|secret|password|passwort|"
            r"name|nombre|nom|from|von|de)\W{0,4}$")
CUES_AGAINST = r"(?i)(?:version|isbn|order|page|seite|página|total|sum|build|release|figure|table|no|nr|§)\W{0,4}$"

# Each pattern is written so that it can be matched without going back: a run
# is taken as a whole (possessive), and a run that failed isn't tried again
# from its middle.  The matches are those of the plain forms.
_LOCAL = "[A-Za-z0-9._%+-]"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": _CARD,  # the plain form's matches of 12 to 19 digits
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": r"[\"'][A-Za-z0-9+/_=-]{16,}+[\"']",
    "person": rf"\b(?:{'|'.join(NAMES + tuple(t + '[.]?' for t in TITLES))})\x20[A-Z][a-zà-ÿ]+",
}
VOTES = ("shape", "gazetteer", "words", "neighbours", "variety")
_CONTEXT = 24
_SPAN = "array<struct<start:int,no:int,end:int,kind:string,base:boolean,shape:int,gazetteer:int,words:int,neighbours:int,variety:int,size:int>>"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn; an empty one does."""
    turned = F.split(F.reverse(digits), "")

    def add(a: Column, i: Column) -> Column:
        d = F.coalesce(F.get(turned, i).try_cast("int"), F.lit(0))
        return a + F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    """The base check of a match."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(_digits(m))
    return F.length(_digits(m)).between(9, 15) if kind == "phone" else F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    no = F.lit(False) if no is None else no
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _candidate(kind: str, x: Column) -> Column:
    """The labelers' votes on a match: struct (start, end, m, left, right)."""
    m, left, right = x["m"], x["left"], x["right"]
    base = _passes(kind, m) if kind in KINDS[:BASE] else F.lit(False)
    shape = {"token": _vote(m.rlike("[0-9]") & m.rlike("[A-Za-z]"), ~m.rlike("[0-9]")), "person": _vote(~m.rlike(r"(?i)\b(?:street|road|inc)\b"))}.get(
        kind, _vote(base, ~base))
    known = {"email": m.rlike(r"(?i)@[a-z0-9.-]*mail"), "phone": m.rlike(r"^\+(?:1|33|34|49)[^0-9]"), "card": _digits(m).rlike("^(?:4|5[1-5]|3[47]|6011)"),
             "person": m.rlike(rf"^(?:{'|'.join(NAMES)})\b")}.get(kind, F.lit(False))
    inside = left.rlike("[A-Za-z0-9_#=]$") | right.rlike("^[A-Za-z0-9_]")
    size = F.size(F.array_distinct(F.split(F.lower(m), "")))
    name = F.when(base, kind).otherwise("number") if kind == "card" else F.when(base, kind).otherwise("") if kind in KINDS[:BASE] else F.lit(kind)
    return F.struct(
        x["start"].alias("start"),
        (F.when(base, KINDS.index("card")).otherwise(KINDS.index("number")) if kind == "card" else F.lit(KINDS.index(kind))).cast("int").alias("no"),
        x["end"].alias("end"), name.alias("kind"), base.alias("base"), shape.cast("int").alias("shape"),
        _vote(known, m.rlike(PLACEHOLDERS)).cast("int").alias("gazetteer"),
        _vote(left.rlike(CUES_FOR), left.rlike(CUES_AGAINST)).cast("int").alias("words"),
        _vote(~inside if kind != "token" else left.rlike(r"[=:]\s*$"), inside).cast("int").alias("neighbours"),
        _vote(size >= 5, size <= 2).cast("int").alias("variety"),
        F.least(F.floor((x["end"] - x["start"]) / 8), F.lit(5)).cast("int").alias("size"))


def with_candidates(docs: DataFrame, text: str, out: str = "__candidates") -> DataFrame:
    """``docs`` with all candidates of each text, by start, then kind.

    A pattern's matches and the gaps between them come from one extraction
    and one split of a text that has any; running lengths give the places,
    in code points."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    none = F.array().cast("array<string>")
    hint = {"email": F.contains(t, F.lit("@")), "ip": t.rlike("[0-9][.]"), "card": t.rlike("[0-9]"), "phone": F.contains(t, F.lit("+")),
            "token": t.rlike("[\"']"), "person": F.lit(True)}  # cheap, and true wherever the pattern matches
    docs = docs.withColumns({f"__has_{k}": hint[k] & t.rlike(p) for k, p in PATTERNS.items()})
    docs = docs.withColumns({f"__m_{k}": F.when(F.col(f"__has_{k}"), F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none) for k, p in PATTERNS.items()}
                            | {f"__g_{k}": F.when(F.col(f"__has_{k}"), F.split(t, p, -1)).otherwise(none) for k, p in PATTERNS.items()})

    def placed(kind: str) -> Column:
        m, g = F.col(f"__m_{kind}"), F.col(f"__g_{kind}")
        kind_of = "struct<at:int,out:array<struct<start:int,end:int,m:string,left:string,right:string>>>"

        def step(a: Column, i: Column) -> Column:
            start = a["at"] + F.length(F.get(g, i))
            end = start + F.length(F.get(m, i))
            row = F.struct(start.alias("start"), end.alias("end"), F.get(m, i).alias("m"), F.right(F.get(g, i), F.lit(_CONTEXT)).alias("left"),
                           F.left(F.get(g, i + 1), F.lit(1)).alias("right"))
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(row)).alias("out")).cast(kind_of)

        first = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(kind_of)
        return F.when(F.size(m) > 0, F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), first, step, lambda a: a["out"])).otherwise(first["out"])

    docs = docs.withColumns({f"__p_{k}": placed(k) for k in PATTERNS})

    def judged(kind: str) -> Column:
        return F.transform(f"__p_{kind}", lambda x: _candidate(kind, x)).cast(_SPAN)

    spans = F.concat(*map(judged, PATTERNS))
    drop = [f"__{x}_{k}" for x in ("has", "m", "g", "p") for k in PATTERNS]
    return docs.withColumn(out, F.sort_array(F.filter(spans, lambda x: x["kind"] != ""))).drop(*drop)


@dataclass
class Model:
    """Weights of the span classifier, by feature name; the labelers' reliabilities are kept for the record."""

    weights: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, float] = field(default_factory=dict)

    def likelihood(self, x: Column) -> Column:
        total = F.lit(self.weights.get("bias", -9.0))
        for v in VOTES:
            total = total + F.when(x[v] > 0, self.weights.get(f"{v}+", 0.0)).when(x[v] < 0, self.weights.get(f"{v}-", 0.0)).otherwise(0.0)
        for prefix, col, values in (("kind", x["kind"], KINDS), ("size", x["size"], range(6))):
            total = total + F.coalesce(*[F.when(col == n, self.weights.get(f"{prefix}{n}", 0.0)) for n in values], F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(candidates: DataFrame, column: str = "__candidates") -> Model:
    """The model of all candidates; without any it accepts only base spans."""
    each = candidates.select(F.explode(column).alias("x")).groupBy(*[F.col(f"x.{c}").alias(c) for c in ("kind", "size", *VOTES)]).agg(F.count("*").alias("n"))
    rows = sorted((r.kind, r["size"], tuple(r[v] for v in VOTES), r.n) for r in each.collect())
    if not rows:
        return Model()
    reliability, posterior = expectation_maximisation([(k, v, n) for k, _, v, n in rows])
    names = ["bias", *(f"{v}{s}" for v in VOTES for s in "+-"), *(f"kind{k}" for k in KINDS), *(f"size{s}" for s in range(6))]
    feature = {n: i for i, n in enumerate(names)}
    x = [[0, *(feature[f"{v}{'+' if a > 0 else '-'}"] for v, a in zip(VOTES, votes) if a), feature[f"kind{k}"], feature[f"size{s}"]] for k, s, votes, _ in rows]
    return Model(dict(zip(names, logistic(x, posterior, [n for *_, n in rows], len(names)))), reliability)


def expectation_maximisation(rows: list[tuple[str, tuple[int, ...], int]], rounds: int = 40) -> tuple[dict[str, float], list[float]]:
    """Of (kind, votes, count) rows: each labeler's reliability (how much
    likelier it votes right than wrong, when it votes) and each row's
    likelihood of being personal data (Dawid and Skene 1979, a share for each
    kind).  It starts from the votes' sums, which tells the two classes apart."""
    q = [1 / (1 + math.exp(-sum(v))) for _, v, _ in rows]
    table = {}
    for _ in range(rounds):
        table = {}
        for j in range(len(VOTES)):
            for y in (0, 1):
                seen = {a: 1.0 for a in (-1, 0, 1)}
                for (_, v, n), p in zip(rows, q):
                    seen[v[j]] += n * (p if y else 1 - p)
                total = sum(seen.values())
                for a in seen:
                    table[j, y, a] = seen[a] / total
        share = {}
        for k in {r[0] for r in rows}:
            mine = [(n, p) for (kind, _, n), p in zip(rows, q) if kind == k]
            share[k] = (1 + sum(n * p for n, p in mine)) / (2 + sum(n for n, _ in mine))
        q = []
        for k, v, _ in rows:
            log = math.log(share[k] / (1 - share[k])) + sum(math.log(table[j, 1, a] / table[j, 0, a]) for j, a in enumerate(v))
            q.append(1 / (1 + math.exp(-max(-30.0, min(30.0, log)))))
    right = {v: (table[j, 1, 1] + table[j, 0, -1]) / (table[j, 1, 1] + table[j, 0, -1] + table[j, 0, 1] + table[j, 1, -1]) for j, v in enumerate(VOTES)}
    return right, q


def logistic(rows: list[list[int]], targets: list[float], counts: list[int], width: int, rounds: int = 300, rate: float = 2.0, l2: float = 1e-3) -> list[float]:
    """Logistic regression of soft targets on binary features, by gradient
    steps over the counted patterns."""
    w, total = [0.0] * width, sum(counts)
    for _ in range(rounds):
        g = [l2 * a for a in w]
        for x, t, n in zip(rows, targets, counts):
            miss = (1 / (1 + math.exp(-sum(w[i] for i in x))) - t) * n / total
            for i in x:
                g[i] += miss
        w = [a - rate * b for a, b in zip(w, g)]
    return w


def accepted(candidates: str, model: Model) -> Column:
    """The spans of a row's candidates: base ones, and those the classifier accepts."""
    return F.filter(candidates, lambda x: x["base"] | (model.likelihood(x) >= 0.5))


def find(docs: DataFrame, keep: list[str], text: str = "text") -> tuple[DataFrame, Model]:
    """The columns ``keep`` of every row with ``spans`` (start, no, end, kind,
    base, the votes; code points, end exclusive), and the model.

    A null text is an empty one and has no spans; repeated rows stay and
    count.  An empty table gives an empty result.  Spans of one kind don't
    overlap, those of different kinds may."""
    names = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(f"`{text}`").alias("t"))
    held = written(with_candidates(rows, "t").drop("t"), "pii")
    model = fit(held)
    return held.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], accepted("__candidates", model).alias("spans")), model


def redact(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """``docs`` with each span of its texts replaced by its kind in brackets
    (spans that overlap, by the first one's).  Other columns come back as they
    were; a null text stays null."""
    names = docs.columns
    at = f"c{names.index(text)}"
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    found = with_candidates(rows, at)
    if model is None:  # rows and their candidates are written once, for the fit and for the replacement
        found = written(found, "pii")
        model = fit(found)
    found = found.withColumn("__spans", accepted("__candidates", model))
    t = F.col(at)

    def step(a: Column, x: Column) -> Column:
        more = F.concat(a["out"], F.substring(t, a["at"] + 1, x["start"] - a["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(x["start"] >= a["at"], more).otherwise(a["out"]).alias("out"))

    done = F.aggregate("__spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t))))
    return found.withColumn(at, F.when(F.size("__spans") > 0, done).otherwise(t)).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def digest_form(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the spans."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
