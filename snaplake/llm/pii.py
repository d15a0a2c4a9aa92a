"""Personal data by pattern, checksum and context (DataFrame operations only).

Regular expressions propose spans, checks confirm them (Luhn for cards, mod 97
for IBANs, ranges and digit counts), and context words near a span move its
score. Base kinds that pass their check always stay; the further kinds (iban,
account) stay when their score reaches ``MIN_SCORE``.

Patterns are written with possessive repeats and run-start anchors where those
cannot change a match, so that long runs of digits or letters neither recurse
deeply nor take quadratic time. Matches of a text are walked in runs of ``RUN``, so that
the lists that grow along the walk, and the text it cuts from, stay short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import free_name

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "account")
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "account": r"(?<![A-Za-z0-9.+-])[0-9]{8,13}(?![A-Za-z0-9.-])",
}
#: Score of a proposal, what a passed checksum adds, and what a context word adds.
SCORES = {"email": (0.8, 0.0, 0.1), "ip": (0.6, 0.0, 0.2), "card": (0.4, 0.4, 0.2), "phone": (0.6, 0.0, 0.3),
          "iban": (0.3, 0.4, 0.2), "account": (0.2, 0.0, 0.5)}
CONTEXT = {
    "email": r"mail|contact|kontakt|correo|courriel", "ip": r"\bip\b|address|server|host|login|adresse",
    "card": r"card|visa|credit|karte|tarjeta|carte|payment", "phone": r"phone|call|tel|fax|mobil|telefon|llama",
    "iban": r"iban|bank|account|konto|cuenta|compte",
    "account": r"account|passport|ssn|social security|konto|cuenta|compte|kundennummer|tax id",
}
NEAR = 40
MIN_SCORE = 0.5
RUN = 128


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _mod97(text: Column) -> Column:
    flat = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(flat, F.lit(5)), F.substring(flat, 1, 4))
    return F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substr(turned, i, F.lit(1)))), F.lit(0),
        lambda r, c: F.when(c < 65, (r * 10 + c - 48) % 97).otherwise((r * 100 + c - 55) % 97)) == 1


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
                        & (F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255))
    if kind == "card":
        d = _digits(hit)
        return F.length(d).between(14, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return _mod97(hit) if kind == "iban" else F.lit(True)


#: A text without this can hold no match of the kind, and its pattern isn't run.
HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}",
        "account": r"[0-9]{8}"}


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with an array column ``out`` of (start, rank, end, kind, score), ordered
    by start, then kind as in ``KINDS``; code points, end exclusive.

    Null and empty texts have no spans. Each kind's matches are leftmost and
    do not overlap; matches that fail their check are dropped without a retry,
    and spans of different kinds may overlap. All rows and other columns stay; a
    column named ``out`` is replaced."""
    docs = docs.drop(out)
    keep = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    names = {k: free_name(docs, f"__{out}_{k}") for k in KINDS}
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")

    def hits(kind: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0)
        seek = F.contains(text, F.lit("@")) if kind == "email" else F.regexp_like(text, F.lit(HINT[kind]))
        return F.when(seek, found).otherwise(F.array().cast("array<string>")).alias(names[kind])

    def placed(kind: str) -> Column:
        """Spans: what lies between matches, and the matches, have lengths."""
        got = F.col(names[kind])
        prior, check, context = SCORES[kind]
        pairs = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), got.alias("hit"))
        steps = F.transform(F.slice(pairs, 1, F.size(got)), lambda x: F.struct(
            F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.coalesce(_valid(kind, x["hit"]), F.lit(False)).alias("good")))
        length = lambda run: F.aggregate(run, F.lit(0), lambda n, x: n + x["gap"] + x["hit"])

        def walk(run: Column, at: Column) -> Column:
            first = F.greatest(at - NEAR, F.lit(0))  # of the stretch of text that this run's contexts are cut from

            def spans(piece: Column) -> Column:
                def step(acc: Column, x: Column) -> Column:
                    s, e = acc["at"] + x["gap"], acc["at"] + x["gap"] + x["hit"]
                    lo = F.greatest(s - NEAR, F.lit(0))
                    around = F.concat_ws(" ", F.substr(piece, lo - first + 1, s - lo), F.substr(piece, e - first + 1, F.lit(NEAR)))
                    near = F.when(F.regexp_like(F.lower(around), F.lit(CONTEXT[kind])), context).otherwise(0.0)
                    span = F.struct(s.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), e.alias("end"), F.lit(kind).alias("kind"),
                                    F.least(F.lit(1.0), F.lit(prior + check) + near).alias("score"))
                    return F.struct(e.alias("at"), F.when(x["good"], F.array_append(acc["all"], span)).otherwise(acc["all"]).alias("all"))

                return F.aggregate(run, F.struct(at.alias("at"), empty.alias("all")), step)["all"]

            return _let(F.substr(text, first + 1, at - first + length(run) + NEAR), spans)

        found = _walked(steps, F.lit(0), lambda at, run: at + length(run), walk)
        if kind not in BASE:
            found = F.filter(found, lambda x: x["score"] >= MIN_SCORE)
        return F.when(F.size(got) > 0, found).otherwise(empty).alias(names[kind])

    found = docs.select(*keep, *[hits(k) for k in KINDS])
    found = found.select(*keep, *[placed(k) for k in KINDS])
    return found.select(*keep, F.array_sort(F.concat(*[F.col(names[k]) for k in KINDS])).alias(out))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _walked(items: Column, start: Column, after: Callable[[Column, Column], Column], walk: Callable[[Column, Column], Column]) -> Column:
    """``walk(run, state)`` of each run of ``RUN`` items, one list after another; a run starts
    with the state that ``after(state, run)`` made of the runs before it."""
    def runs_of(all_: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / RUN).cast("int")),
                           lambda i: F.slice(all_, (i * RUN + 1).cast("int"), F.lit(RUN)))

    def states(runs: Column) -> Column:
        zero = F.struct(start.alias("now"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(runs, zero, lambda acc, run: F.struct(
            after(acc["now"], run).alias("now"), F.array_append(acc["all"], acc["now"]).alias("all")))["all"]

    def joint(all_: Column) -> Column:
        return _let(runs_of(all_), lambda runs: F.flatten(F.transform(
            F.arrays_zip(runs.alias("run"), states(runs).alias("at")), lambda x: walk(x["run"], x["at"]))))

    return _let(items, joint)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """``docs`` with every span of ``spans_col`` replaced by ``<kind>``.

    Overlapping spans become one, named after the first; null texts stay null."""
    text, cuts = F.col(f"`{text_col}`"), F.col(f"`{spans_col}`")
    last = lambda run, start: F.aggregate(run, start, lambda n, x: F.greatest(n, x["end"]))

    def walk(run: Column, at: Column) -> Column:
        def parts(piece: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                part = F.concat(F.substr(piece, acc["at"] - at + 1, x["start"] - acc["at"]), F.lit("<"), x["kind"], F.lit(">"))
                return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                                F.when(x["start"] >= acc["at"], F.array_append(acc["all"], part)).otherwise(acc["all"]).alias("all"))

            return F.aggregate(run, F.struct(at.alias("at"), F.array().cast("array<string>").alias("all")), step)["all"]

        return _let(F.substr(text, at + 1, last(run, at) - at), parts)

    clean = F.concat(F.array_join(_walked(cuts, F.lit(0), lambda at, run: last(run, at), walk), ""),
                     F.substr(text, last(cuts, F.lit(0)) + 1))
    return docs.withColumn(text_col, F.when((F.size(cuts) > 0) & text.isNotNull(), clean).otherwise(text))


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, the SHA-256 of the joined base
    spans, and all spans joined. Null text counts as empty."""
    found = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    base = F.filter("pii", lambda x: x["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))
