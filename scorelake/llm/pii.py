"""Personal data by weak supervision, in DataFrame functions only.

Loose patterns propose candidate spans. Four labelers vote for, against or not at all on each: the strict pattern with
its check, a gazetteer (top-level domains, dialling codes, issuer prefixes, reserved networks), the words before the
span, and the span's own shape. Expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is, without labels. Its posteriors train the final span classifier, naive Bayes over votes and span features, by
weighted counts. Candidates that it accepts are added to the base spans, which stay as they are.

Texts are read once; matches and the words before them go to a narrow table. Positions and overlaps come from running
totals in rounds, so a text of very many matches takes little more than its length. Vote patterns are at most 3**4 a kind and
features a few dozen values, so everything learned is small whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.session import stage

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that no match needs backtracking over what it has read: a run that can't match from its
#: first character can't from a later one. \G lets a match begin right after the one before.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@| ?[\[(](?:at|AT)[\])] ?)[A-Za-z0-9-]++(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]|(?<![0-9+.()-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}
#: What a text must hold for a pattern to be tried.
HINT = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": r"[0-9]\.[0-9]++\.[0-9]|:[0-9A-Fa-f]{1,4}:", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]|[0-9][ .-][0-9]{4}"}
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "eu", "us", "uk", "de", "fr", "es", "it", "nl", "ch", "at", "be", "se", "no", "dk", "fi", "pl", "pt", "ru", "cn", "jp", "in", "br", "ca", "au", "mx")
DIALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "351", "353", "358", "420", "421")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|36|38|6011|65|35)"
RESERVED = r"^(?:0|127|22[4-9]|2[345][0-9])\."
CONTEXT = {
    "email": (r"mail|contact|write to|address|kontakt|correo|courriel|reply", r"example of|regex|pattern"),
    "ip": (r"\bip\b|address|host|server|client|from|login|adresse", r"version|release|\bv\.?\s*$|section|chapter|§"),
    "card": (r"card|visa|master|amex|credit|payment|karte|carte|tarjeta", r"isbn|order|invoice|serial|tracking|\bid\b|issn|ean|sku"),
    "phone": (r"phone|\btel|call|fax|mobile|cell|contact|telefon|tél|teléfono", r"isbn|order|invoice|serial|\bid\b|part no|model"),
}
LABELERS, VALUES = 4, (-1, 0, 1)
ROUNDS, SMOOTH = 25, 0.5
#: A candidate is added from this posterior of the classifier.
ACCEPT = 0.9
BEFORE = 24


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array under an associative ``join``, in a number of rounds that grows as its logarithm.

    Round k joins each total with the one 2**k places before, which covers the places just before its own.
    """

    def turn(totals: Column, k: Column) -> Column:
        step = F.pow(F.lit(2), k).cast("int")
        return F.transform(totals, lambda t, i: F.when(i >= step, join(F.get(totals, i - step), t)).otherwise(t))

    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    return F.when(rounds == 0, values).otherwise(F.aggregate(F.sequence(F.lit(0), rounds - 1), values, turn))


def matches(text: Column, kind: str, patterns: dict[str, str]) -> Column:
    """Leftmost non-overlapping matches as ``start, end`` (code points, end exclusive), ``found`` and ``before``."""
    pattern = patterns[kind]
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,found:string,before:string>>")

    def entry(pair: Column, end: Column) -> Column:
        before = F.substring(pair["piece"], -BEFORE, BEFORE)
        return F.struct((end - F.length(pair["hit"])).alias("start"), end.alias("end"), pair["hit"].alias("found"), before.alias("before"))

    def placed(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda p: F.length(p["piece"]) + F.length(p["hit"]))
        return F.zip_with(pairs, with_value(sizes, lambda v: running(v, lambda x, y: x + y)), entry)

    pairs = with_value(found, lambda f: F.zip_with(F.slice(pieces, F.lit(1), F.size(f)), f, lambda p, h: F.struct(p.alias("piece"), h.alias("hit"))))
    return F.when(F.rlike(text, F.lit(HINT[kind])) & F.rlike(text, F.lit(pattern)), with_value(pairs, placed)).otherwise(none)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check."""

    def digit(total: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 1, 2 * d).otherwise(d)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), digit) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    """The check that a match of the base pattern must pass."""
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.rlike(p, F.lit("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
    if kind == "card":
        number = digits(found)
        return F.length(number).between(14, 19) & luhn(number)
    if kind == "phone":
        return F.length(digits(found)).between(10, 15)
    return F.lit(True)


def listed(value: Column, names: tuple[str, ...]) -> Column:
    return value.isin(*names)


def votes(kind: str, found: Column, before: Column) -> list[Column]:
    """Votes of the strict pattern, the gazetteer, the context and the shape: 1, 0 or -1."""
    strict = F.when(F.rlike(found, F.lit(rf"\A(?:{STRICT[kind]})\z")) & passes(kind, found), 1).otherwise(-1)
    number, low = digits(found), F.lower(before)
    yes, no = CONTEXT[kind]
    context = F.when(F.rlike(low, F.lit(yes)), 1).when(F.rlike(low, F.lit(no)), -1).otherwise(0)
    if kind == "email":
        known = F.when(listed(F.lower(F.regexp_extract(found, r"([A-Za-z0-9-]+)$", 1)), DOMAINS), 1).otherwise(-1)
        shape = F.when(F.rlike(found, F.lit(r"^[A-Za-z0-9].*[A-Za-z]{2,}$")), 1).otherwise(-1)
    elif kind == "ip":
        known = F.when(F.rlike(found, F.lit(RESERVED)), -1).otherwise(1)
        shape = F.when(F.rlike(found, F.lit(r"^[1-9][0-9]{0,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}$|:")), 1).otherwise(-1)
    elif kind == "card":
        known = F.when(F.rlike(number, F.lit(ISSUERS)), 1).otherwise(-1)
        shape = F.when(F.rlike(found, F.lit(r"^(?:[0-9]{15,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})$")), 1).otherwise(-1)
    else:
        code = F.regexp_extract(found, r"^\+([0-9]{1,3})", 1)
        known = F.when(code == "", 0).when(F.exists(F.array(*[F.substring(code, 1, n) for n in (1, 2, 3)]), lambda c: listed(c, DIALLING)), 1).otherwise(-1)
        shape = F.when(F.length(number).between(10, 13), 1).otherwise(-1)
    return [strict, known, context, shape]


def features(kind: str, found: Column, before: Column) -> Column:
    """Names of the span's features, beside the votes."""
    return F.array(
        F.concat(F.lit("length:"), F.least(F.length(found), F.lit(40)).cast("string")),
        F.concat(F.lit("digits:"), F.least(F.length(digits(found)), F.lit(20)).cast("string")),
        F.concat(F.lit("marks:"), F.least(F.length(F.regexp_replace(found, "[A-Za-z0-9]", "")), F.lit(8)).cast("string")),
        F.concat(F.lit("after:"), F.coalesce(F.nullif(F.regexp_extract(before, r"([^A-Za-z0-9\s]?\s?)\z", 1), F.lit("")), F.lit("word"))),
    )


def base_spans(text: Column) -> Column:
    """Array of ``start, place, kind, end``, in the order of the contract."""

    def of(place: int, kind: str) -> Column:
        kept = F.filter(matches(text, kind, STRICT), lambda m: passes(kind, m["found"]))
        return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    return F.array_sort(F.concat(*[of(place, kind) for place, kind in enumerate(KINDS)]))


def candidates(text: Column) -> Column:
    """Array of candidate spans of all kinds with their votes and features."""

    def one(kind: str, place: int) -> Callable[[Column], Column]:
        def entry(m: Column) -> Column:
            cast = votes(kind, m["found"], m["before"])
            names = F.concat(features(kind, m["found"], m["before"]), F.array(*[F.concat(F.lit(f"vote{i}:"), v.cast("string")) for i, v in enumerate(cast)]))
            return F.struct(m["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), m["end"].alias("end"), F.array(*cast).alias("votes"), names.alias("names"))

        return entry

    return F.concat(*[F.transform(matches(text, kind, LOOSE), one(kind, place)) for place, kind in enumerate(KINDS)])


def with_free(base: Column, found: Column) -> Column:
    """Candidates with ``free``: whether they share no character with a base span of their kind.

    All spans stand on one line, each kind on a stretch of its own, in order; then the furthest end of the base spans up to
    a candidate and the first start of those after it tell.
    """
    far = F.lit(1 << 40)

    def at(s: Column, field: str) -> Column:
        return s["place"].cast("long") * F.lit(1 << 32) + s[field]

    nothing = F.lit(None).cast("struct<start:int,place:int,kind:string,end:int,votes:array<int>,names:array<string>>")
    known = F.transform(base, lambda b: F.struct(at(b, "start").alias("low"), F.lit(0).alias("candidate"), at(b, "end").alias("high"), nothing.alias("span")))
    asked = F.transform(found, lambda c: F.struct(at(c, "start").alias("low"), F.lit(1).alias("candidate"), at(c, "end").alias("high"), c.alias("span")))

    def marked(line: Column) -> Column:
        ends = F.transform(line, lambda s: F.when(s["candidate"] == 0, s["high"]).otherwise(F.lit(-1).cast("long")))
        starts = F.reverse(F.transform(line, lambda s: F.when(s["candidate"] == 0, s["low"]).otherwise(far)))
        before = with_value(ends, lambda v: running(v, F.greatest))
        after = F.reverse(with_value(starts, lambda v: running(v, F.least)))
        clear = F.zip_with(before, after, lambda x, y: F.struct(x.alias("before"), y.alias("after")))
        told = F.zip_with(line, clear, lambda s, c: F.struct(s["candidate"].alias("candidate"), s["span"].alias("span"), ((c["before"] <= s["low"]) & (c["after"] >= s["high"])).alias("free")))
        return F.transform(F.filter(told, lambda t: t["candidate"] == 1), lambda t: F.struct(t["span"].alias("span"), t["free"].alias("free")))

    return with_value(F.array_sort(F.concat(known, asked)), marked)


def estimate(patterns: DataFrame) -> DataFrame:
    """``kind, votes, posterior`` of every vote pattern, by expectation-maximisation inside one expression.

    ``patterns`` has ``kind, votes, count``. The state is the share of true spans and, for both truths, how often each
    labeler casts each vote; it begins with labelers that are right more often than wrong.
    """
    right, wrong = [0.1, 0.2, 0.7] * LABELERS, [0.7, 0.2, 0.1] * LABELERS
    first = F.struct(F.lit(0.5).alias("share"), F.array(*map(F.lit, right)).alias("true"), F.array(*map(F.lit, wrong)).alias("false"))

    def chance(table: Column, cast: Column) -> Column:
        out = F.lit(1.0)
        for i in range(LABELERS):
            out = out * F.element_at(table, F.element_at(cast, i + 1) + F.lit(3 * i + 2))
        return out

    def posterior(state: Column, cast: Column) -> Column:
        yes, no = state["share"] * chance(state["true"], cast), (1 - state["share"]) * chance(state["false"], cast)
        return yes / (yes + no)

    def total(rows: Column, weight: Callable[[Column], Column]) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda s, r: s + weight(r))

    def improved(rows: Column) -> Column:
        mass, whole = total(rows, lambda r: r["q"] * r["count"]), total(rows, lambda r: r["count"])

        def table(side: Callable[[Column], Column], all_of: Column) -> Column:
            def cell(labeler: int, value: int) -> Column:
                seen = total(rows, lambda r: F.when(F.element_at(r["votes"], labeler + 1) == value, side(r) * r["count"]).otherwise(0.0))
                return (seen + SMOOTH) / (all_of + SMOOTH * len(VALUES))

            return F.array(*[cell(i, v) for i in range(LABELERS) for v in VALUES])

        return F.struct(((mass + SMOOTH) / (whole + 2 * SMOOTH)).alias("share"), table(lambda r: r["q"], mass).alias("true"), table(lambda r: 1 - r["q"], whole - mass).alias("false"))

    def turn(state: Column, _: Column) -> Column:
        rows = F.transform(F.col("rows"), lambda r: F.struct(r["votes"].alias("votes"), r["count"].alias("count"), posterior(state, r["votes"]).alias("q")))
        return F.element_at(F.transform(F.array(rows), improved), 1)

    grouped = patterns.groupBy("kind").agg(F.collect_list(F.struct("votes", F.col("count").cast("double").alias("count"))).alias("rows"))
    fitted = grouped.select("kind", "rows", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, turn).alias("state"))
    return fitted.select("kind", "state", F.explode("rows").alias("row")).select("kind", F.col("row.votes").alias("votes"), posterior(F.col("state"), F.col("row.votes")).alias("posterior"))


def classifier(spans: DataFrame) -> DataFrame:
    """``kind, odds, weights``: log odds, and log ratio of every feature, from candidates with posteriors."""
    mass = spans.groupBy("kind").agg(F.sum("posterior").alias("yes"), F.sum(1 - F.col("posterior")).alias("no"))
    odds = F.log((F.col("yes") + SMOOTH) / (F.col("no") + SMOOTH))
    seen = spans.select("kind", "posterior", F.explode("names").alias("name")).groupBy("kind", "name").agg(F.sum("posterior").alias("with_yes"), F.sum(1 - F.col("posterior")).alias("with_no"))
    ratio = F.log((F.col("with_yes") + SMOOTH) / (F.col("yes") + 2 * SMOOTH)) - F.log((F.col("with_no") + SMOOTH) / (F.col("no") + 2 * SMOOTH))
    weights = F.map_from_entries(F.collect_list(F.struct("name", ratio)))
    return seen.join(F.broadcast(mass), "kind").groupBy("kind").agg(F.first(odds).alias("odds"), weights.alias("weights"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of every row, repeated rows too.

    A null text is empty. Added spans are candidates with a posterior of at least ``ACCEPT`` that share no character with
    a base span of their kind. Without candidates, as in an empty table, nothing is learned or added. Rows with the same
    doc_id and text have the same spans; columns other than doc_id and text are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = F.struct(base_spans(text).alias("base"), candidates(text).alias("found"))
    told = with_value(both, lambda r: F.struct(r["base"].alias("base"), with_free(r["base"], r["found"]).alias("candidates")))
    read = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), told.alias("read")), "pii").select("doc_id", "tie", "read.*")
    spans = read.where(F.size("candidates") > 0).select("doc_id", "tie", F.explode("candidates").alias("c")).select("doc_id", "tie", "c.span.*", "c.free")
    patterns = stage(spans.groupBy("kind", "votes").count(), "pii-votes")
    weighed = spans.join(F.broadcast(estimate(patterns)), ["kind", "votes"])
    model = stage(classifier(weighed), "pii-model")
    score = F.aggregate("names", F.col("odds"), lambda s, n: s + F.coalesce(F.element_at("weights", n), F.lit(0.0)))
    accepted = spans.where("free").join(F.broadcast(model), "kind").where(score >= F.log(F.lit(ACCEPT / (1 - ACCEPT))))
    added = accepted.groupBy(F.col("doc_id").alias("id"), F.col("tie").alias("hash")).agg(F.collect_set(F.struct("start", "place", "kind", "end")).alias("added"))
    out = read.drop("candidates").join(added, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("hash")), "left")
    more = F.coalesce("added", F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, KINDS), F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.array_sort(F.concat("base", more))).alias("spans"), F.size(more).cast("long").alias("n_added"))
