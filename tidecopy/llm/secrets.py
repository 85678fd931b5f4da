r"""Secrets in texts, with multipart credentials linked, with DataFrame functions only.

A credential has parts: an identifier, a secret and often an endpoint. Some parts
are plain by themselves (the base kinds: assigned secrets, access ids, long hex
numbers); others are weak, as ordinary texts are full of them: a name after
``user=``, a mixed run of letters and digits, a short assignment, a URL. A weak
part is reported only where what completes it stands close by in the same scope
(a paragraph): within ``reach`` code points of an identifier there is

* a base secret, or a weak one and an endpoint,

and likewise of a weak secret a base identifier, or a weak one and an endpoint; of
an endpoint both an identifier and a secret. A weak part that overlaps a base span
is that span's and not reported again.

Texts are matched where they are read; only matches are shuffled. A match's place
is the running sum of what ``split`` leaves between matches. Parts are joined as
intervals: both sides are dealt to the cells of ``reach`` code points that they
touch, widened on one side by ``reach``, and meet by text, scope and cell, so a
part meets those near it and never a text's or a group's other parts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecopy.llm._store import Stage

#: kinds of spans in the order in which they are listed; the first three are base kinds
KINDS = ("assign", "access", "hex", "ident", "value", "endpoint")
_ASSIGN, _ACCESS, _HEX, _IDENT, _VALUE, _ENDPOINT, _BREAK, _TEXT = range(8)

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
IDENT = r"""(?i)(access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{4,}"""
VALUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""(https?|ftp|s3|gs|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
BREAK = r"\n[\x20\x09\x0D]*\n"


@dataclass(frozen=True)
class SecretRules:
    """Least code points of base spans (``assign``: of the assigned value), of weak ones,
    the longest weak value (longer runs are data), and how near parts must be."""

    assign: int = 12
    access: int = 18
    hex: int = 16
    weak_assign: int = 6
    weak_access: int = 12
    longest_value: int = 128
    reach: int = 256


def _matches(text: Column, kind: int, pattern: str, extra=lambda x: F.lit(0)) -> Column:
    """Kind, number, code points since the match before, code points, extra of each match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    rows = F.zip_with(F.transform(between, lambda g: F.length(g)),
                      F.transform(found, lambda x: F.struct(F.length(x).alias("len"), extra(x).cast("int").alias("extra"))),
                      lambda g, x: F.struct(g.alias("gap"), x["len"].alias("len"), x["extra"].alias("extra")))
    rows = F.transform(rows, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"),
                                                   x["len"].alias("len"), x["extra"].alias("extra")))
    return F.when(F.rlike(text, F.lit(pattern)), rows).otherwise(F.array().cast(_MATCHES))


_MATCHES = "array<struct<kind: int, i: int, gap: int, len: int, extra: int>>"


def _any(*cols: str) -> Column:
    return sum((F.size(c) for c in cols[1:]), F.size(cols[0])) > 0


def _found(docs: DataFrame, rules: SecretRules, id_col: str, text_col: str) -> DataFrame:
    """A row per row of ``docs``: rid, doc_id, its matches (weak kinds only where parts could link)."""
    text, none = F.col("text"), F.array().cast(_MATCHES)
    assigned = lambda x: F.length(F.regexp_extract(x, ASSIGN, 2))
    mixed = lambda x: ((F.length(x) <= rules.longest_value) & F.rlike(x, F.lit("[0-9]"))
                       & F.rlike(x, F.lit("[a-z]")) & F.rlike(x, F.lit("[A-Z]")))
    t = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    t = t.select("*", _matches(text, _ASSIGN, ASSIGN, assigned).alias("assign"), _matches(text, _ACCESS, ACCESS).alias("access"),
                 _matches(text, _HEX, "[0-9a-f]{%d,}" % rules.hex).alias("hex"))
    t = t.withColumn("ident", _matches(text, _IDENT, IDENT))
    t = t.withColumn("value", F.when(_any("access", "ident"), _matches(text, _VALUE, VALUE, mixed)).otherwise(none))
    linked = _any("access", "ident") & _any("assign", "hex", "value")
    rest = F.concat("ident", "value", _matches(text, _ENDPOINT, ENDPOINT), _matches(text, _BREAK, BREAK))
    return t.select("rid", "doc_id", F.concat("assign", "access", "hex", F.when(linked, rest).otherwise(none)).alias("found"))


def _parts(found: DataFrame, rules: SecretRules) -> DataFrame:
    """rid, doc_id, kind, start, end, base, scope of the matches that count; and one
    row of kind ``_TEXT`` per row with matches, so that none is lost."""
    text = F.struct(F.lit(_TEXT).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit(0).alias("len"),
                    F.lit(0).alias("extra"))
    m = (found.where(F.size("found") > 0)
         .select("rid", "doc_id", F.explode(F.concat("found", F.array(text))).alias("m")).select("rid", "doc_id", "m.*")
         .repartition("rid"))
    seen = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(seen))
    m = m.withColumn("start", F.col("end") - F.col("len"))
    is_ = lambda k: F.col("kind") == k
    base = ((is_(_ASSIGN) & (F.col("extra") >= rules.assign)) | (is_(_ACCESS) & (F.col("len") >= rules.access)) | is_(_HEX))
    kind = (F.when(base | is_(_IDENT) | is_(_ENDPOINT) | is_(_BREAK) | is_(_TEXT), F.col("kind"))
            .when(is_(_ASSIGN) & (F.col("extra") >= rules.weak_assign), F.lit(_VALUE))
            .when(is_(_ACCESS) & (F.col("len") >= rules.weak_access), F.lit(_IDENT))
            .when(is_(_VALUE) & (F.col("extra") == 1), F.lit(_VALUE)))
    m = m.select("rid", "doc_id", kind.alias("kind"), "start", "end", base.alias("base")).where("kind is not null")
    before = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return m.withColumn("scope", F.sum(is_(_BREAK).cast("long")).over(before)).where(~is_(_BREAK))


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak parts that are completed: an interval join of weak parts with all parts near them."""
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach)))
    real = parts.where(F.col("kind") < _BREAK)
    weak = real.where(~F.col("base")).select(
        "rid", "doc_id", "scope", "kind", "start", "end", cells(F.col("start") - reach, F.col("end") + reach).alias("cell"))
    near = real.select(F.col("rid").alias("n_rid"), F.col("scope").alias("n_scope"), F.col("kind").alias("n_kind"),
                       F.col("base").alias("n_base"), F.col("start").alias("n_start"), F.col("end").alias("n_end"),
                       cells(F.col("start"), F.col("end")).alias("n_cell"))
    met = weak.join(near, (F.col("rid") == F.col("n_rid")) & (F.col("scope") == F.col("n_scope")) & (F.col("cell") == F.col("n_cell"))
                    & (F.col("n_start") <= F.col("end") + reach) & (F.col("start") <= F.col("n_end") + reach))
    has = lambda cond: F.max(F.coalesce(cond, F.lit(False)))
    ident, secret = F.col("n_kind").isin(_ACCESS, _IDENT), F.col("n_kind").isin(_ASSIGN, _HEX, _VALUE)
    sums = met.groupBy("rid", "kind", "start", "end").agg(
        F.first("doc_id").alias("doc_id"),
        has(F.col("n_base") & (F.col("n_start") < F.col("end")) & (F.col("start") < F.col("n_end"))).alias("inside"),
        has(ident).alias("id"), has(ident & F.col("n_base")).alias("plain_id"), has(secret).alias("secret"),
        has(secret & F.col("n_base")).alias("plain_secret"), has(F.col("n_kind") == _ENDPOINT).alias("endpoint"))
    good = F.expr(f"""CASE kind WHEN {_IDENT} THEN plain_secret OR (secret AND endpoint)
                                WHEN {_VALUE} THEN plain_id OR (id AND endpoint)
                                WHEN {_ENDPOINT} THEN id AND secret END""")
    return sums.where(~F.col("inside") & good).select("rid", "doc_id", "kind", "start", "end", F.lit(False).alias("base"))


def secret_spans(docs: DataFrame, rules: SecretRules = SecretRules(), *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (array of start, end, kind, base, in
    code points, the end exclusive; by start, then kind in the order of ``KINDS``).

    A null or empty text has no spans; a null id stays null; repeated rows each give
    a row (rows are numbered when staged, so equal ones don't meet); an empty table
    gives an empty result; other columns don't matter. A text of any length is
    matched whole; its matches, not its words, go through one window.
    """
    stage = Stage(docs.sparkSession, "secrets")
    found = stage.write(_found(docs, rules, id_col, text_col))
    parts = stage.write(_parts(found, rules))
    spans = (parts.where(F.col("base") | (F.col("kind") == _TEXT)).select("rid", "doc_id", "kind", "start", "end", "base")
             .unionByName(_linked(parts, rules.reach)))
    names = F.array(*[F.lit(k) for k in KINDS])
    span = F.struct("start", "kind", "end", "base")
    per = spans.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.when(F.col("kind") != _TEXT, span))).alias("s"))
    listed = F.transform("s", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                                                 F.get(names, x["kind"]).alias("kind"), x["base"].alias("base")))
    none = F.array().cast("array<struct<start: bigint, end: bigint, kind: string, base: boolean>>")
    return (found.where(F.size("found") == 0).select("doc_id", none.alias("spans"))
            .unionAll(per.select("doc_id", listed.alias("spans"))))


def span_digests(spans: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, base_sha256, spans as text."""
    said = lambda xs: F.array_join(F.transform(
        xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    return spans.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
