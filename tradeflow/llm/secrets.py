"""Secret scan, with DataFrame functions alone.

Three kinds are found by pattern: assignments to telling names, access keys, long hex runs. A fourth,
entropy, looks at candidate strings (runs of the letters of base64). Parts that read as words or numbers
(words joined by capitals, versions, dates, units) are taken out of a candidate up to its next
separator, for they are what slugs, paths, identifiers and file names consist of. Over what is left, if
it is long enough, a window of WINDOW characters slides by character class: hex, capitals and digits, or
any. The counts of its characters are kept up to date, one in and one out, and with them the sum of
c * log2(c) that gives the Shannon entropy. A candidate whose highest window reaches the threshold of
its class is a secret, unless the allow-list knows it: ids with a public format, dummies.

Where a pattern matches follows from the pieces of text between its matches, so that
positions cost one more pass over the texts that have a match and nothing for the others.

Defined results. A null or empty text has no spans. Offsets count code points, ends are
exclusive. Spans may overlap; redact() merges them. Ties in start are ordered by kind. Repeated
rows are scanned alike, an empty table gives no rows, and other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import fresh, let, quoted

# The kinds in order, and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
WINDOW = 16
# class: (what is left of the candidate, least entropy in bits of its best window)
CLASSES = {
    "hex": (r"^[0-9a-fA-F]+=*$", 2.7),
    "capitals": (r"^[A-Z0-9]+=*$", 3.0),
    "any": (r"", 3.5),
}
# Quantifiers are possessive where they repeat: no backtracking, however long the candidate.
SHORT = r"(?:[A-Z][a-z](?![a-z]))?+"  # By, On: one at a time between longer words
HUMPS = rf"(?:{SHORT}[A-Z]*+[a-z]{{2,}}+)*+{SHORT}"  # readCsvFile, HTTPServer, rateByLabel
PARTS = (
    # words, with two numbers at most
    rf"(?:[a-z](?=[A-Z][a-z]{{2}}))?+{HUMPS}[A-Z]*+(?:\d{{1,8}}+{HUMPS}[A-Z]{{0,2}}+){{0,2}}+",
    r"[A-Za-z]\d{0,4}+",  # v2, A4
    r"\d++[A-Za-z]{0,2}+",  # 2024, 1080p, 4th
)
WORDLIKE = rf"(?<![A-Za-z0-9])(?:{'|'.join(PARTS)})(?:[_/+-]++|(?==*$))"
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
    r"(?i)example|placeholder|changeme|x{6}|0123456789|1234567890|abcdef",
)
SPAN = "struct<start:int,rank:int,end:int>"


def _found(text: Column, pattern: str, rank: int, keep) -> Column:
    """Spans of the matches that keep(match, group 2) accepts, leftmost and non-overlapping."""
    none = F.array().cast(f"array<{SPAN}>")
    has_key = pattern == ASSIGN

    def spans(pieces: Column) -> Column:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if has_key else matches

        def place(found: Column) -> Column:
            match, value = found["matches"], found["values"]

            def step(acc: Column, i: Column) -> Column:
                start = acc["pos"] + F.length(pieces[i])
                end = start + F.length(match[i])
                span = F.struct(
                    start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")
                ).cast(SPAN)
                more = F.when(keep(match[i], value[i]), F.array(span)).otherwise(none)
                return F.struct(end.alias("pos"), F.concat(acc["out"], more).alias("out"))

            return F.aggregate(
                F.sequence(F.lit(0), F.size(match) - 1),
                F.struct(F.lit(0).alias("pos"), none.alias("out")),
                step,
                lambda acc: acc["out"],
            )

        both = F.struct(matches.alias("matches"), values.alias("values"))
        return F.when(F.size(pieces) > 1, let(both, place)).otherwise(none)

    return let(F.split(text, pattern, -1), spans)


def highest_entropy(candidate: Column) -> Column:
    """Largest Shannon entropy, in bits, of any WINDOW characters in a row."""
    bits = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])

    def slide(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            entering = codes[i]
            leaving = F.when(i >= WINDOW, codes[F.greatest(i - WINDOW, F.lit(0))]).otherwise(-1)
            changes = (i < WINDOW) | (entering != leaving)
            more = acc["counts"][entering]
            less = acc["counts"][F.greatest(leaving, F.lit(0))]
            total = acc["total"] + F.when(
                changes,
                bits[more + 1]
                - bits[more]
                + F.when(leaving >= 0, bits[F.greatest(less - 1, F.lit(0))] - bits[less]).otherwise(0.0),
            ).otherwise(0.0)
            counts = F.when(
                changes,
                F.transform(
                    acc["counts"],
                    lambda n, j: n + (j == entering).cast("int") - (j == leaving).cast("int"),
                ),
            ).otherwise(acc["counts"])
            entropy = F.when(i >= WINDOW - 1, math.log2(WINDOW) - total / WINDOW).otherwise(0.0)
            return F.struct(
                counts.alias("counts"),
                total.alias("total"),
                F.greatest(acc["best"], entropy).alias("best"),
            )

        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1),
            F.struct(
                F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
                F.lit(0.0).alias("total"),
                F.lit(0.0).alias("best"),
            ),
            step,
            lambda acc: acc["best"],
        )

    codes = F.transform(
        F.split(candidate, ""), lambda c: F.greatest(F.instr(F.lit(ALPHABET), c) - 1, F.lit(0))
    )
    return let(codes, slide)


def unread(candidate: Column) -> Column:
    """What is left of a candidate without the parts that read as words or numbers."""
    return F.regexp_replace(candidate, WORDLIKE, "")


def _is_secret(candidate: Column, _: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)

    def high(rest: Column) -> Column:
        least = F.lit(CLASSES["any"][1])
        for name in ("capitals", "hex"):
            inside, bits = CLASSES[name]
            least = F.when(rest.rlike(inside), bits).otherwise(least)
        return F.when(F.length(rest) < WINDOW, False).otherwise(highest_entropy(rest) >= least)

    return F.when(allowed, False).otherwise(let(unread(candidate), high))


def spans(text: Column) -> Column:
    """All spans of a text as array<struct<start, rank, end>>, by start, then kind."""
    whole = F.coalesce(text, F.lit(""))
    every = let(
        whole,
        lambda t: F.concat(
            _found(t, ASSIGN, 0, lambda m, v: F.length(v) >= ASSIGN_LEAST),
            _found(t, ACCESS, 1, lambda m, v: F.length(m) >= ACCESS_LEAST),
            _found(t, HEX, 2, lambda m, v: F.lit(True)),
            _found(t, CANDIDATE, 3, _is_secret),
        ),
    )
    return F.sort_array(every)


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(
        found, lambda s: F.concat_ws(":", names[s["rank"]], s["start"], s["end"])
    )
    return F.concat_ws(",", each)


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by the mark; overlapping spans become one."""
    state = "struct<done:int,out:array<string>>"

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["done"]
        gap = F.substring(text, acc["done"] + 1, s["start"] - acc["done"])
        out = F.when(new, F.concat(acc["out"], F.array(gap, F.lit(mark)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["done"], s["end"]).alias("done"), out.alias("out")).cast(state)

    def finish(acc: Column) -> Column:
        rest = F.substring(text, acc["done"] + 1, F.length(text))
        return F.concat(F.concat_ws("", acc["out"]), rest)

    start = F.struct(F.lit(0).alias("done"), F.array().cast("array<string>").alias("out")).cast(state)
    return F.when(F.size(found) > 0, F.aggregate(found, start, step, finish)).otherwise(text)


def scan(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """docs with a column of spans."""
    return docs.withColumn(into, spans(quoted(text)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the secrets in their texts replaced."""
    (found,) = fresh(docs.columns, "secret_spans")
    clean = {c: redacted(quoted(c), F.col(found)) if c == text else quoted(c) for c in docs.columns}
    return scan(docs, text, found).select(*[column.alias(c) for c, column in clean.items()])


def secrets(docs: DataFrame) -> DataFrame:
    """Digest of the scan, one row per document."""
    found = scan(docs.select("doc_id", "text"))
    of = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        of(3).alias("n_entropy"),
    )
