"""Personal data: exact base patterns, and spans added by weak supervision. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in order. The look-behinds and possessive quantifiers only spare the search starts that cannot match: a match
#: begins where the last one ended or at the first character of a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kinds the method may add, by pattern. All are searched in one pass; the first alternative that fits names the kind.
ADDED = {
    "phone": r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "key": r"(?:AKIA[A-Z0-9]{16}|(?:password|passwd|secret|token|api_key)\x20{0,2}[=:]\x20{0,2}\x22?[A-Za-z0-9_/+-]{8,128}\x22?)(?![A-Za-z0-9])",
    "email": r"[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,63}){1,8}",
}
KINDS = [*BASE, *[k for k in ADDED if k not in BASE]]
CANDIDATE = r"(?<![A-Za-z0-9._%+-])(?:" + "|".join(ADDED.values()) + ")"
SIGNS = r"[0-9=:(\[]"  # every candidate holds one of these
#: What the labelers know.
DOMAIN_ENDS = r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|uk)$"
IBAN_COUNTRIES = r"^(?:AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PT)"
KEY_WORDS = r"^(?:AKIA|password|passwd|secret|token|api_key)"
CUES = {"email": "mail|contact|write", "phone": "phone|tel|call|mobile|fax", "ssn": "ssn|social|security", "iban": "iban|account|bank|konto", "key": "password|token|key|secret|login"}
LABELERS, ROUNDS = ("form", "gazetteer", "context", "shape"), 40
LENGTHS, SHARES = (12, 20, 40), (0.25, 0.75)
SPAN = "array<struct<start:bigint,rank:int,kind:string,stop:bigint>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often and within whatever loop it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, combine) -> Column:
    """Array whose item at each place combines all of ``values`` (numbers) up to there.

    Each round combines every item with the one a power of two before it, so n items take log n rounds, and no array grows item by item.
    """
    numbers = values.cast("array<bigint>")

    def round_(done, step):
        return F.transform(done, lambda x, i: F.when(i >= step, combine(x, F.get(done, i - step))).otherwise(x)).cast("array<bigint>")

    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers))).cast("int") - 1), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.when(F.size(numbers) > 1, F.aggregate(steps, numbers, round_)).otherwise(numbers)


def _found(text: Column, pattern: str, row, kind: str) -> Column:
    """Array of ``row(start, hit, text before)`` of all matches for which it is not NULL, in order.

    Positions are code points. Matches and the texts between them come from the same search, so their lengths add up to
    positions; they are only taken apart where there is a match.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(kind)

    def placed(both):
        ends = _running(F.transform(both, lambda x: F.char_length(x["before"]) + F.char_length(x["hit"])), lambda one, other: one + other)
        return F.transform(F.arrays_zip(both.alias("both"), ends.alias("end")), lambda x: row(x["end"] - F.char_length(x["both"]["hit"]), x["both"]["hit"], x["both"]["before"]))

    # one more text than matches: the last has none after it
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)).alias("before"), hits.alias("hit"))
    return F.when(F.size(hits) > 0, F.filter(_bound(pairs, placed), lambda x: x.isNotNull()).cast(kind)).otherwise(none)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    digit = lambda i: F.substring(turned, i, 1).cast("int")
    doubled = lambda i: F.when(digit(i) > 4, digit(i) * 2 - 9).otherwise(digit(i) * 2)
    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda s, i: s + F.when(i % 2 == 0, doubled(i)).otherwise(digit(i))) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    if kind == "ip":
        value = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(hit, r"\."), lambda p: F.coalesce(value(p).try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        digits = _digits(hit)
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    return F.length(_digits(hit)).between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, rank, kind, stop) of the base patterns, by start and then by kind."""
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        def row(start, hit, before, rank=rank, kind=kind):
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (start + F.char_length(hit)).alias("stop"))
            return F.when(_holds(kind, hit), span)

        one = _found(text, pattern, row, SPAN)
        sign = {"email": "@", "phone": r"\+", "ip": "[0-9]", "card": "[0-9]"}[kind]
        found.append(F.when(text.rlike(sign), one).otherwise(F.array().cast(SPAN)))
    return F.array_sort(F.concat(*found))


def _votes(kind: Column, hit: Column, before: Column) -> list[Column]:
    """What the labelers say of a candidate: 1 for, -1 against, 0 nothing."""
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    digits, letters = _digits(hit), F.length(F.regexp_replace(hit, "[^A-Za-z]", ""))
    is_ = lambda k: kind == k
    form = vote((is_("phone") & hit.startswith("(")) | (is_("email") & hit.rlike(r"^\S+$")) | (is_("key") & hit.rlike(r"^AKIA|[=:]"))
                | (is_("iban") & (F.length(F.regexp_replace(hit, " ", "")).between(15, 32))) | (is_("ssn") & ~hit.rlike("^(000|666|9)")),
                (is_("ssn") & hit.rlike("^(000|666|9)")) | (is_("phone") & hit.rlike(r"^\(?[01]")))
    gazetteer = vote((is_("email") & hit.rlike(DOMAIN_ENDS)) | (is_("iban") & hit.rlike(IBAN_COUNTRIES)) | (is_("key") & hit.rlike(KEY_WORDS)),
                     (is_("iban") & ~hit.rlike(IBAN_COUNTRIES)) | (is_("email") & ~hit.rlike(DOMAIN_ENDS)))
    near = F.lower(F.right(before, F.lit(32)))
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = cue | (is_(k) & near.rlike(words))
    dull = digits.rlike(r"^(\d)\1*$") & (letters == 0)
    mixed = (F.length(digits) > 3) & ((letters > 3) | ~is_("key")) & ~dull
    return [form, gazetteer, vote(cue, F.lit(False)), vote(mixed, dull | (is_("key") & (F.length(digits) == 0)))]


CELL = "struct<start:bigint,stop:bigint,kind:string,form:int,gazetteer:int,context:int,shape:int,size:int,share:int>"


def candidates(text: Column) -> Column:
    """Array of candidates with their votes and the bucketed features of the classifier."""
    def row(start, hit, before):
        kind = F.lit(None).cast("string")
        for name, pattern in reversed(ADDED.items()):
            kind = F.when(hit.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
        size, share = F.lit(0), F.lit(0)
        for limit in LENGTHS:
            size = size + F.when(F.length(hit) >= limit, 1).otherwise(0)
        for limit in SHARES:
            share = share + F.when(F.length(_digits(hit)) >= limit * F.length(hit), 1).otherwise(0)
        votes = [v.alias(n) for v, n in zip(_votes(kind, hit, before), LABELERS)]
        return F.when(kind.isNotNull(), F.struct(start.alias("start"), (start + F.char_length(hit)).alias("stop"), kind.alias("kind"), *votes,
                                                 size.alias("size"), share.alias("share")))

    return F.when(text.rlike(SIGNS), _found(text, CANDIDATE, row, f"array<{CELL}>")).otherwise(F.array().cast(f"array<{CELL}>"))


@dataclass
class SpanModel:
    """Reliabilities of the labelers and the weights of the span classifier."""

    prior: float = 0.5
    reliability: dict[str, dict[int, tuple[float, float]]] = field(default_factory=dict)
    weights: dict[tuple[str, object], float] = field(default_factory=dict)

    @staticmethod
    def features(cell: dict) -> list[tuple[str, object]]:
        return [("bias", 0), *[(name, cell[name]) for name in ("kind", *LABELERS, "size", "share")]]

    def fit(self, cells: list[dict]) -> SpanModel:
        """Estimate reliabilities by expectation-maximisation, then train the classifier on the posteriors.

        ``cells`` are distinct combinations of votes and features with their ``rows``; their number is bounded by the number
        of combinations, whatever the input.
        """
        belief = [0.9 if sum(c[n] for n in LABELERS) > 0 else 0.1 for c in cells]
        total = sum(c["rows"] for c in cells) or 1
        for _ in range(ROUNDS):
            self.prior = min(0.99, max(0.01, sum(b * c["rows"] for b, c in zip(belief, cells)) / total))
            for name in LABELERS:
                says = {v: [1.0 + (v > 0), 1.0 + (v < 0)] for v in (-1, 0, 1)}
                for b, c in zip(belief, cells):
                    says[c[name]][0] += b * c["rows"]
                    says[c[name]][1] += (1 - b) * c["rows"]
                sums = [sum(s[i] for s in says.values()) for i in (0, 1)]
                self.reliability[name] = {v: (s[0] / sums[0], s[1] / sums[1]) for v, s in says.items()}
            belief = [self.posterior(c) for c in cells]
        for _ in range(300):
            slopes: dict[tuple[str, object], float] = {}
            for b, c in zip(belief, cells):
                miss = (self.chance(c) - b) * c["rows"] / total
                for feature in self.features(c):
                    slopes[feature] = slopes.get(feature, 0.0) + miss
            for feature, slope in slopes.items():
                weight = self.weights.get(feature, 0.0)
                self.weights[feature] = weight - 1.0 * (slope + 1e-4 * weight)
        return self

    def posterior(self, cell: dict) -> float:
        """Probability of personal data given the votes alone."""
        odds = math.log(self.prior / (1 - self.prior))
        for name in LABELERS:
            yes, no = self.reliability[name][cell[name]]
            odds += math.log(yes / no)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))

    def chance(self, cell: dict) -> float:
        odds = sum(self.weights.get(f, 0.0) for f in self.features(cell))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))

    def accepts(self, cell: Column) -> Column:
        """The classifier as an expression over a candidate."""
        odds = F.lit(self.weights.get(("bias", 0), 0.0))
        for (name, value), weight in self.weights.items():
            if name != "bias":
                odds = odds + F.when(cell[name] == value, weight).otherwise(0.0)
        return odds > 0


def train(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Learn from the candidates of all documents. Runs a job; the driver gets one row per combination of votes and features."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cells = docs.select(F.explode(candidates(text)).alias("c")).select("c.*").groupBy("kind", *LABELERS, "size", "share").agg(F.count(F.lit(1)).alias("rows"))
    return SpanModel().fit([r.asDict() for r in cells.orderBy("kind", *LABELERS, "size", "share").collect()])


def all_spans(base: Column, found: Column, model: SpanModel) -> Column:
    """Base spans, and accepted candidates that overlap none of them, by start and then by kind.

    Base spans by their start and candidates by their stop are put in one order; a candidate is free if no base span before it in that
    order, that is, none that starts before the candidate stops, reaches beyond the candidate's start.
    """
    rank = lambda kind: F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int") - 1
    accepted = F.filter(found, model.accepts)
    point = lambda at, is_base, reach, span: F.struct(at.alias("at"), F.lit(is_base).alias("base"), reach.alias("reach"), span.alias("span"))
    span_of = lambda x, place: F.struct(x["start"].alias("start"), place.alias("rank"), x["kind"].alias("kind"), x["stop"].alias("stop"))
    kind = "array<struct<at:bigint,base:boolean,reach:bigint,span:struct<start:bigint,rank:int,kind:string,stop:bigint>>>"
    bases = F.transform(base, lambda b: point(b["start"], True, b["stop"], span_of(b, b["rank"]))).cast(kind)
    others = F.transform(accepted, lambda c: point(c["stop"], False, F.lit(-1), span_of(c, rank(c["kind"])))).cast(kind)

    def free(points):
        reach = _running(points["reach"], lambda one, other: F.greatest(one, other))
        kept = F.filter(F.arrays_zip(points.alias("point"), reach.alias("reach")), lambda x: ~x["point"]["base"] & (x["reach"] <= x["point"]["span"]["start"]))
        return F.transform(kept, lambda x: x["point"]["span"])

    # false comes before true: a base span that starts where the candidate stops does not overlap it
    added = _bound(F.array_sort(F.concat(bases, others)), free)
    return F.when(F.size(accepted) > 0, F.array_sort(F.concat(base, added.cast(SPAN)))).otherwise(F.array_sort(base))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def with_spans(docs: DataFrame, model: SpanModel, text: Column, keep: list[Column]) -> DataFrame:
    """``keep``, ``_base`` and ``_spans``."""
    searched = docs.select(*keep, text.alias("_text"), base_spans(text).alias("_base"), candidates(text).alias("_found"))
    return searched.select(*[F.col(f"`{c}`") for c in searched.columns if c != "_found"], all_spans(F.col("_base"), F.col("_found"), model).alias("_spans"))


def personal_data(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    ``spans`` are kind:start:end, joined by commas, in code points. NULL texts are empty; repeated rows and NULL ids are searched like any
    other; other columns are not read. No shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = with_spans(docs, model, text, [F.col(id_col).cast("bigint").alias("doc_id")])
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"))


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind; one that begins before an earlier one ends, by the text after that."""
    def pieces(spans, reach):
        before = F.transform(reach, lambda _, i: F.coalesce(F.get(reach, i - 1), F.lit(0)))
        return F.filter(F.arrays_zip(spans.alias("span"), before.alias("at")), lambda x: x["span"]["start"] >= x["at"])

    def joined(kept, last, part):
        kind = lambda x: F.concat(F.lit("<"), F.upper(x["span"]["kind"]), F.lit(">"))
        return F.concat(F.array_join(F.transform(kept, lambda x: F.concat(part(x["at"], x["span"]["start"]), kind(x))), ""), part(last, F.char_length(text)))

    # a substring is counted off from the beginning of the text: with many spans the text is taken apart into characters once
    few = lambda at, stop: F.substring(text, (at + 1).cast("int"), (stop - at).cast("int"))
    many = lambda chars: lambda at, stop: F.array_join(F.slice(chars, (at + 1).cast("int"), (stop - at).cast("int")), "")

    def replaced(reach):
        kept, last = pieces(spans, reach), F.array_max(reach)
        return F.when(F.size(spans) <= 32, joined(kept, last, few)).otherwise(_bound(F.split(text, ""), lambda chars: joined(kept, last, many(chars))))

    return _bound(_running(F.transform(spans, lambda s: s["stop"]), lambda one, other: F.greatest(one, other)), replaced)


def redacted(docs: DataFrame, model: SpanModel, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with each span of ``text_col`` replaced by its kind, as in ``<EMAIL>``; overlapping spans by the first of them.

    All columns as they are, in order; ``chars_col``, if there is one, is counted anew where the text has changed. NULL stays NULL.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    text = F.coalesce(F.col("_row").getField(text_col), F.lit(""))
    found = with_spans(packed, model, text, [F.col("_row")])

    clean = _replaced(F.col("_text"), F.col("_spans"))
    clean = F.when(F.size("_spans") > 0, clean).otherwise(F.col("_row").getField(text_col))
    counted = F.when(F.size("_spans") > 0, F.char_length(clean)).otherwise(F.col("_row").getField(chars_col)) if chars_col in names else None
    new = {text_col: clean, chars_col: counted}
    kind = dict(docs.dtypes)
    return found.select(*[new[c].cast(kind[c]).alias(c) if new.get(c) is not None else F.col("_row").getField(c).alias(c) for c in names])
