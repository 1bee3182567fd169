"""Personal data: base patterns, and terms that reveal them by corpus co-occurrence. SQL functions alone.

A protected entity is the value of a base span (an address, a number). For each
entity the terms of the documents that hold it are counted over the whole corpus. The
information that a term gives about an entity, PMI = ln(N df(t,e) / (df(t) df(e))),
as a share of all information about it, IC = ln(N / df(e)), is its disclosure:
1 if the term never occurs without the entity. Terms over a threshold are
generalised, over a higher one removed, wherever they stand in a document with
that entity. An entity of a single document gets none: each word that no other
document holds would tell of it as much as its owner's name does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import texts
from contrail.session import settle

#: The base kinds in their order, with the words that replace them.
KINDS = ["email", "ip", "card", "phone", "generalised", "removed"]
#: Documents that must hold a term and an entity before it counts as evidence.
MIN_SUPPORT = 2
GENERALISE_FROM, REMOVE_FROM = 0.8, 0.95
WORD = r"[\p{L}\p{N}\p{M}_]+"

# The base patterns, with possessive loops, and no start inside a run that has failed.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

_BLOCK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0), lambda acc, x: acc + x)


def totals_before(array: Column) -> Column:
    """For each element of an array of ints the sum of those before it; blocks keep it near linear."""

    def running(values: Column) -> Column:
        last = F.expr("0") + F.floor((F.size(values) - 1) / _BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), last), lambda b: total(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))))
        heads = let(sums, lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))))
        return let(
            heads,
            lambda h: F.transform(
                values,
                lambda _, i: F.get(h, F.floor(i / _BLOCK).cast("int")) + total(F.slice(values, i - i % _BLOCK + 1, i % _BLOCK)),
            ),
        )

    return F.when(F.size(array) > 0, running(array)).otherwise(F.array().cast("array<int>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether a string of digits passes: from the right, every second digit doubled, less 9 if over 9."""

    def worth(x: Column, i: Column) -> Column:
        d = x.cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    each = F.filter(F.split(F.reverse(value), ""), lambda x: x != "")
    return total(F.transform(each, worth)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(12, 19) & _luhn(d))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """One name for all ways of writing an entity."""
    return F.concat(F.lit(kind + ":"), F.lower(value) if kind in ("email", "ip") else _digits(value))


def _words(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def _terms(text: Column) -> Column:
    """Words of a text as `term`, `start`, `end`."""
    hits, gaps = F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.split(text, WORD, -1)

    def places(h: Column, g: Column) -> Column:
        before = totals_before(F.transform(h, lambda x, i: F.length(x) + F.length(F.get(g, i))))
        return let(
            before,
            lambda b: F.transform(
                h,
                lambda x, i: F.struct(
                    F.lower(x).alias("term"),
                    (F.get(b, i) + F.length(F.get(g, i))).alias("start"),
                    (F.get(b, i) + F.length(F.get(g, i)) + F.length(x)).alias("end"),
                ),
            ),
        )

    return let(hits, lambda h: let(gaps, lambda g: places(h, g)))


def base_spans(docs: DataFrame) -> DataFrame:
    """Spans of the base kinds, one row per row of `doc_id`, `text`.

    `base`: array of kind (place in KINDS), start, end. `entities`: the distinct ones.
    `row`: a name of the id and the text. `text`: NULL if there is no entity.
    """
    guards = {
        "email": (EMAIL, F.col("text").contains("@")),
        "ip": (IP, F.col("text").rlike(r"[0-9]\.[0-9]")),
        "card": (CARD, F.col("text").rlike(r"[0-9][\x20-]?[0-9]")),
        "phone": (PHONE, F.col("text").contains("+")),
    }
    none = F.array().cast("array<string>")
    out = docs.withColumn("row_hash", F.xxhash64("text"))
    for kind, (pattern, guard) in guards.items():
        out = out.withColumn(f"{kind}_hits", F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
        out = out.withColumn(f"{kind}_gaps", F.when(F.size(f"{kind}_hits") > 0, F.split("text", pattern, -1)).otherwise(none))
    for kind in guards:
        gaps = F.col(f"{kind}_gaps")
        before = totals_before(F.transform(F.col(f"{kind}_hits"), lambda x, i: F.length(x) + F.length(F.get(gaps, i))))
        out = out.withColumn(f"{kind}_before", before)
    for number, kind in enumerate(guards):
        gaps, before = F.col(f"{kind}_gaps"), F.col(f"{kind}_before")

        def span(x: Column, i: Column) -> Column:
            start = F.get(before, i) + F.length(F.get(gaps, i))
            return F.struct(
                F.lit(number).alias("kind"),
                start.alias("start"),
                (start + F.length(x)).alias("end"),
                _entity(kind, x).alias("entity"),
                _valid(kind, x).alias("valid"),
            )

        out = out.withColumn(f"{kind}_spans", F.filter(F.transform(F.col(f"{kind}_hits"), span), lambda s: s["valid"]))
    out = out.withColumn("found", F.concat(*(F.col(f"{kind}_spans") for kind in guards)))
    return out.select(
        "doc_id",
        "row_hash",
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "row_hash").alias("row"),
        F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("base"),
        F.array_distinct(F.transform("found", lambda s: s["entity"])).alias("entities"),
        F.when(F.size("found") > 0, F.col("text")).alias("text"),
    )


def disclosing_terms(docs: DataFrame, held: DataFrame, entity: DataFrame, min_support: int, generalise_from: float, remove_from: float) -> DataFrame:
    """`entity`, `term`, `kind` (generalised or removed) from `held`: one row for each entity and distinct term of a
    document; and `entity`: `entity`, `with_entity`.
    """
    rows = docs.count()
    pair = held.groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= min_support)
    words = docs.select(F.explode(_words(F.col("text"))).alias("term"))
    term = words.groupBy("term").agg(F.count("*").alias("with_term"))
    n = F.lit(float(rows))
    pmi = F.log(n * F.col("both") / (F.col("with_term") * F.col("with_entity")))
    share = F.when(F.col("with_entity") < rows, pmi / F.log(n / F.col("with_entity"))).otherwise(F.lit(0.0))
    return (
        pair.join(entity, "entity")
        .join(term, "term")
        .withColumn("share", share)
        .where(F.col("share") >= generalise_from)
        .select("entity", "term", F.when(F.col("share") >= remove_from, 5).otherwise(4).alias("kind"))
    )


def personal_spans(
    docs: DataFrame,
    min_support: int = MIN_SUPPORT,
    generalise_from: float = GENERALISE_FROM,
    remove_from: float = REMOVE_FROM,
) -> DataFrame:
    """Spans of personal data, one row per row of `docs`.

    Columns: `doc_id`, `n_email`, `n_ip`, `n_card`, `n_phone`, `base_sha256`,
    `spans`, `span_list` (kind, start, end; kind is a place in KINDS). Spans count
    code points, the end exclusive. Added spans never touch a base span; a term
    that tells of several entities of its document gets its strongest kind. Entities
    of fewer than `min_support` documents get none. NULL and empty texts have no
    spans. Repeated rows count as documents of their own and get the same spans.
    An empty table gives no rows.
    """
    docs = texts(docs)
    found = settle(base_spans(docs), "personal")
    named = found.select("row", F.explode("entities").alias("entity"))
    entity = settle(named.groupBy("entity").agg(F.count("*").alias("with_entity")).where(F.col("with_entity") >= min_support), "entities")
    shared = named.distinct().join(entity, "entity").groupBy("row").agg(F.collect_set("entity").alias("shared"))
    holders = settle(found.select("row", "text").join(shared, "row"), "holders")
    held = holders.select("row", F.explode("shared").alias("entity"), _words(F.col("text")).alias("words")).select("row", "entity", F.explode("words").alias("term"))
    telling = settle(disclosing_terms(docs, held, entity, min_support, generalise_from, remove_from), "telling")
    marks = held.join(telling, ["entity", "term"]).groupBy("row", "term").agg(F.max("kind").alias("kind"))
    added = (
        holders.select("row", F.explode(_terms(F.col("text"))).alias("t"))
        .select("row", "t.*")
        .join(marks, ["row", "term"])
        .groupBy("row", "start", "end")
        .agg(F.max("kind").alias("kind"))
        .groupBy(F.col("row").alias("a_row"))
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("near"))
    )
    clear = F.filter("near", lambda a: ~F.exists("base", lambda b: (b["start"] < a["end"]) & (b["end"] > a["start"])))
    joined = found.join(added, F.col("row") == F.col("a_row"), "left").withColumn("added", clear)
    every = F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")))
    return joined.select(
        "doc_id",
        *(F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(every).alias("spans"),
        in_order(every).alias("span_list"),
        "row_hash",
    )


def in_order(spans: Column) -> Column:
    """Spans by start, then kind."""
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def written(spans: Column) -> Column:
    """kind:start:end of all spans in order, comma-joined."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(in_order(spans), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """`doc_id` and `text` with spans replaced: base kinds by their name in brackets, generalised terms by
    [number], [name] or [word], removed ones by nothing. Of overlapping spans the later loses what is covered.
    """
    source = texts(docs).withColumn("own_hash", F.xxhash64("text"))
    spans = personal_spans(docs, **options).select(F.col("doc_id").alias("s_id"), F.col("row_hash").alias("s_hash"), "span_list").dropDuplicates(["s_id", "s_hash"])
    joined = source.join(spans, source.doc_id.eqNullSafe(F.col("s_id")) & (F.col("own_hash") == F.col("s_hash")), "left")

    def cut(start: Column, end: Column) -> Column:
        return F.substring("text", start + 1, F.greatest(end - start, F.lit(0)))

    def general(value: Column) -> Column:
        return F.when(value.rlike("^[0-9]"), F.lit("[number]")).when(value.rlike(r"^\p{Lu}"), F.lit("[name]")).otherwise(F.lit("[word]"))

    def step(acc: Column, s: Column) -> Column:
        put = F.when(s["kind"] == 5, F.lit("")).when(s["kind"] == 4, general(cut(s["start"], s["end"])))
        put = put.otherwise(F.concat(F.lit("["), F.get(F.array(*(F.lit(k) for k in KINDS)), s["kind"]), F.lit("]")))
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(F.concat(acc["done"], cut(acc["at"], s["start"]), put).alias("done"), s["end"].alias("at")))

    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    whole = F.aggregate("span_list", begin, step, lambda acc: F.concat(acc["done"], cut(acc["at"], F.length("text"))))
    return joined.select("doc_id", F.coalesce(whole, "text").alias("text"))
