"""Secret scans with linking of multipart credentials.

Strong findings are reported as they are.  Weak ones (a login name, a password under a vague key, an
endpoint, a bare key-like word) mean little alone; they are reported only where the parts that complete
them stand within a scope of so many characters.  The join of parts by interval is a window over each
text's parts, ordered by place, with a range frame as wide as the scope: no pair is ever formed.

All of it is built-in expressions.  Texts are scanned row by row; only what was found is shuffled, once for
every distinct text, by the text's digest.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlens.llm.common import others, whole_text


class Part(NamedTuple):
    """A kind of finding: ``regex`` (ASCII), the ``group`` whose length counts, its ``least`` length, a cheap ``gate``.

    ``role`` is what it contributes to a credential: identifier, secret or endpoint.  A part with ``needs``
    is weak: it is reported only if all those roles stand within its scope.
    """

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    gate: str | None = None
    role: str | None = None
    needs: tuple[str, ...] = ()


_SEP = r"""["']?\x20*[:=]\x20*["']?"""
PARTS = (
    Part("assign", rf"(?i:(password|passwd|secret|token|api_?key)){_SEP}([A-Za-z0-9+/_.=-]+)", 2, 6, None, "secret"),
    Part("access", r"AKIA[A-Z0-9]{16,}", 0, 20, "AKIA", "identifier"),
    Part("hex", r"[0-9a-f]{24,}", 0, 24, None, "secret"),
    Part("login", rf"(?i:(user_?name|user|login|client_?id|account_?id)){_SEP}([A-Za-z0-9@_.+-]+)", 2, 3, None, "identifier", ("secret",)),
    Part("vague", rf"(?i:(pwd|pass|passphrase|auth|credential|private_?key|client_?key)){_SEP}([A-Za-z0-9+/_.=-]+)", 2, 6, None,
         "secret", ("identifier",)),
    Part("endpoint", r"(?:https?|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqps?|s3|ftp)://[A-Za-z0-9._~:@%-]+", 0, 8, "://",
         "endpoint", ("identifier", "secret")),
    Part("bare", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/]{0,40}[0-9])(?=[a-z0-9+/]{0,40}[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_=-])", 0, 40, None,
         "secret", ("identifier",)),
)
#: Kinds of the base contract, in the order in which they are listed.
BASE = ("assign", "access", "hex")
#: Code points between the starts of parts that belong together.
SCOPE = 200


def _found(text: Column, part: Part) -> Column:
    """array<struct<kind, gap, hit>>: leftmost matches that do not overlap, and the text since the last one."""
    hits = F.regexp_extract_all(text, F.lit(part.regex), F.lit(0))
    gaps = F.transform(F.split(text, part.regex, -1), F.char_length)
    pairs = F.transform(hits, lambda hit, i: F.struct(F.lit(part.kind).alias("kind"), i.alias("i"), F.get(gaps, i).alias("gap"), hit.alias("hit")))
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,hit:string>>")
    here = text.rlike(part.regex)
    if part.gate:
        here = F.contains(text, F.lit(part.gate)) & here
    return F.when(here, pairs).otherwise(none)


def _spans(docs: DataFrame, text: str, parts: Sequence[Part], scope: int) -> DataFrame:
    """One row per distinct text that holds anything: digest, spans (kind, start, end) in order of start and kind."""
    value = whole_text(text)
    found = docs.select(F.sha2(value, 256).alias("__digest"), F.explode(F.concat(*(_found(value, p) for p in parts))).alias("f"))
    # copies of a text, and rows that are read twice, find the same: one row of each is left before the shuffle
    rows = found.groupBy("__digest", F.col("f.kind").alias("kind"), F.col("f.i").alias("i")).agg(
        F.max("f.gap").alias("gap"), F.max("f.hit").alias("hit")
    )
    kind = Window.partitionBy("__digest", "kind").orderBy("i")
    size = F.char_length("hit")
    placed = rows.select("__digest", "kind", "hit", F.sum(F.col("gap") + size).over(kind).cast("long").alias("end"))
    counted = F.lit(False)
    order = F.lit(0)
    role = F.lit(None).cast("string")
    for n, p in enumerate(parts):
        this = F.col("kind") == p.kind
        counted = F.when(this, F.char_length(F.regexp_extract("hit", p.regex, p.group) if p.group else F.col("hit")) >= p.least).otherwise(counted)
        order = F.when(this, n).otherwise(order)
        role = F.when(this, F.lit(p.role)).otherwise(role)
    placed = placed.where(counted).select(
        "__digest", "kind", (F.col("end") - size).alias("start"), "end", order.alias("n"), role.alias("role")
    )
    near = Window.partitionBy("__digest").orderBy("start").rangeBetween(-scope, scope)
    roles = sorted({r for p in parts for r in p.needs})
    placed = placed.select("*", *(F.max(F.when(F.col("role") == r, 1).otherwise(0)).over(near).alias(f"near_{r}") for r in roles))
    linked = F.lit(True)
    for p in parts:
        if p.needs:
            whole = F.lit(True)
            for r in p.needs:
                whole = whole & (F.col(f"near_{r}") == 1)
            linked = F.when(F.col("kind") == p.kind, whole).otherwise(linked)
    span = F.struct("start", "n", "kind", "end")
    return placed.where(linked).groupBy("__digest").agg(F.sort_array(F.collect_list(span)).alias("__found"))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, text: str = "text", parts: Sequence[Part] = PARTS, scope: int = SCOPE, out: str = "spans") -> DataFrame:
    """Add ``out``: kind, start and end (code points, end exclusive) of every finding, by start, then in the order of ``parts``.

    Null and empty texts have no spans (an empty array), as have texts without findings.  Repeated rows each get
    their own result; an empty table gives an empty table; a column named ``out`` is replaced, all others are kept.
    A part of a role that stands within ``scope`` code points, start to start, completes a weak part on either side.
    """
    digest = F.sha2(whole_text(text), 256)
    kept = others(docs, [out])
    found = _spans(docs, text, parts, scope)
    rows = docs.select(*kept, digest.alias("__digest_of"))
    joined = rows.join(found, F.col("__digest_of") == F.col("__digest"), "left")
    spans = F.transform("__found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return joined.select(*kept, F.coalesce(spans, F.array().cast(SPANS)).alias(out))


def redacted(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span replaced by ``mask``; spans that touch or overlap become one mask."""
    start = F.struct(F.array().cast("array<struct<a:bigint,b:bigint>>").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        # (a, b): text to keep before this mask; a span inside what is masked already only moves the end
        fresh = (s["start"] > acc["at"]) | ((F.size(acc["done"]) == 0) & (s["start"] == 0))
        done = F.when(fresh, F.concat(acc["done"], F.array(F.struct(acc["at"].alias("a"), s["start"].alias("b"))))).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))

    kept = F.aggregate(
        spans, start, step,
        lambda acc: F.concat(
            F.array_join(F.transform(acc["done"], lambda k: F.concat(F.substring(text, k["a"] + 1, k["b"] - k["a"]), F.lit(mask))), ""),
            F.substring(text, acc["at"] + 1, F.char_length(text)),
        ),
    )
    return F.when(F.size(spans) > 0, kept).otherwise(text)


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
