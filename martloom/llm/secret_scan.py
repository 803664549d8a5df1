"""Secret scan: known shapes, and sliding-window entropy over candidate strings.

DataFrame functions only; no row leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import spare
from martloom.llm.spans import SPAN, let, match_spans, merged, replaced

# kind: pattern, group whose length counts, least length.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # A run of one class is matched whole from its first place on, so asking for
    # the length in the pattern finds the same as dropping short runs afterwards.
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 0),
    "hex": (r"[0-9a-f]{24,}", 0, 0),
}
ENTROPY = "entropy"
ORDER = [*KINDS, ENTROPY]
MASK = "[SECRET]"

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}"
# The characters of a candidate by class; counts are packed into fields of long integers.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/_-")
_BITS = WINDOW.bit_length()
_FIELDS = 63 // _BITS
# Least entropy in bits per character of a window, by the class its characters fall into.
HEX_BITS, MIXED_BITS = 3.0, 3.7
# Candidates that match any of these are not secrets, however random they look.
ALLOW = (
    r"(?i)example|sample|placeholder|changeme|dummy",
    r"(?i)abcdefghij|0123456789|qwertyuiop|deadbeefdeadbeef",
    r"^(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    r"^[A-Za-z]*$",
    r"^[a-z]+([_/-][a-z]+)+$",
)
_FIXED = 1 << 32


def _bound(bits: float) -> int:
    """The largest sum of c*log2(c) over a window's counts that still has so many bits a character."""
    return int(WINDOW * (math.log2(WINDOW) - bits) * _FIXED)


def _sign(char: Column) -> Column:
    """Where a character's count stands among the packed counts, and that of its class."""
    at = F.call_function("instr", F.lit("".join(CLASSES)), char) - 1
    classes = F.array(*[F.lit(i) for i, signs in enumerate(CLASSES) for _ in signs])
    one = lambda shift: F.call_function("shiftleft", F.lit(1).cast("long"), shift)

    def placed(at: Column) -> Column:
        shift = (at % _FIELDS) * _BITS
        return F.struct(
            F.floor(at / _FIELDS).cast("int").alias("word"),
            shift.alias("shift"),
            one(shift).alias("unit"),
            one(F.get(classes, at) * _BITS).alias("kind"),
        )

    return let(at, placed)


def _field(word: Column, shift: Column | int) -> Column:
    shift = shift if isinstance(shift, Column) else F.lit(shift)
    return F.call_function("shiftright", word, shift).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long")).cast("int")


def _window_spans(candidate: Column) -> Column:
    """Merged windows of a candidate string whose entropy reaches its class's threshold.

    Entropy is log2(w) - sum(c*log2(c))/w over the counts c of a window of w
    characters. The counts, of characters and of classes, are kept from window to
    window in fields of long integers: the character that leaves takes one from its
    fields, the one that enters adds one. The sum, a whole number so that it does
    not drift, changes by those two counts alone.
    """
    weight = F.array(*[F.lit(round(c * math.log2(c) * _FIXED) if c else 0) for c in range(WINDOW + 2)])
    change = lambda n: F.get(weight, n + 1) - F.get(weight, n)
    words = -(-sum(map(len, CLASSES)) // _FIELDS)
    empty = F.struct(
        F.lit(0).alias("at"),
        F.array(*[F.lit(0).cast("long")] * words).alias("counts"),
        F.lit(0).cast("long").alias("kinds"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(-1).alias("start"),
        F.lit(-1).alias("end"),
        F.array().cast(f"array<{SPAN}>").alias("done"),
    )

    def moved(w: Column, sign: Column, by: int) -> Column:
        """Counts, classes and sum with one character more or less."""
        counts = F.transform(w["counts"], lambda v, i: F.when(i == sign["word"], v + by * sign["unit"]).otherwise(v))
        held = _field(F.get(w["counts"], sign["word"]), sign["shift"])
        return F.struct(
            counts.alias("counts"),
            (w["kinds"] + by * sign["kind"]).alias("kinds"),
            (w["sum"] + by * change(held if by > 0 else held - 1)).alias("sum"),
        )

    def left(s: Column, signs: Column) -> Column:
        """The window without the character that leaves a full one."""
        kept = F.struct(*[s[c].alias(c) for c in ("counts", "kinds", "sum")])
        return F.when(s["at"] >= WINDOW, moved(s, F.get(signs, s["at"] - WINDOW), -1)).otherwise(kept)

    def random(s: Column, w: Column) -> Column:
        digits, low_hex, low, high_hex, high, _ = (_field(w["kinds"], i * _BITS) for i in range(len(CLASSES)))
        is_hex = (digits + low_hex == WINDOW) | (digits + high_hex == WINDOW)
        kinds = sum((n > 0).cast("int") for n in (digits, low_hex + low, high_hex + high))
        mixed = (w["sum"] <= _bound(MIXED_BITS)) & (kinds > 1) & ~is_hex
        return (s["at"] + 1 >= WINDOW) & (w["sum"] <= _bound(HEX_BITS)) & (is_hex | mixed)

    def step(s: Column, sign: Column, signs: Column) -> Column:
        return let(left(s, signs), lambda w: let(moved(w, sign, 1), lambda w: let(random(s, w), lambda hit: placed(s, w, hit))))

    def placed(s: Column, w: Column, hit: Column) -> Column:
        end = s["at"] + 1
        start = end - WINDOW
        apart = hit & (start > s["end"])
        return F.struct(
            end.alias("at"),
            *[w[c].alias(c) for c in ("counts", "kinds", "sum")],
            F.when(apart, start).otherwise(s["start"]).alias("start"),
            F.when(hit, end).otherwise(s["end"]).alias("end"),
            F.when(apart & (s["start"] >= 0), F.concat(s["done"], F.array(open_(s)))).otherwise(s["done"]).alias("done"),
        )

    def open_(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"))

    last = lambda s: F.when(s["start"] >= 0, F.concat(s["done"], F.array(open_(s)))).otherwise(s["done"])
    signs = F.transform(F.split(candidate, ""), _sign)
    return let(signs, lambda signs: F.aggregate(signs, empty, lambda s, sign: step(s, sign, signs), last))


def entropy_spans(text: Column, allow: Sequence[str] = ALLOW) -> Column:
    """Spans of ``text`` that look random, an array of ``SPAN``."""
    candidates = match_spans(text, CANDIDATE)
    string = lambda x: F.substring(text, x["start"] + 1, x["end"] - x["start"])
    named = F.transform(candidates, lambda x: F.struct(x["start"].alias("start"), string(x).alias("string")))
    listed = lambda x: sum((x["string"].rlike(p).cast("int") for p in allow), F.lit(0)) > 0
    kept = F.filter(named, lambda x: ~listed(x))
    return F.flatten(
        F.transform(
            kept,
            lambda x: F.transform(
                _window_spans(x["string"]),
                lambda s: F.struct((s["start"] + x["start"]).alias("start"), (s["end"] + x["start"]).alias("end")),
            ),
        )
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, by start and then kind as listed."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _of_kind(kind: str, spans: Column) -> Column:
    def named(x: Column) -> Column:
        rank = F.lit(ORDER.index(kind)).alias("rank")
        return F.struct(x["start"].alias("start"), rank, x["end"].alias("end"), F.lit(kind).alias("kind"))

    return F.transform(spans, named)


def with_secrets(documents: DataFrame, allow: Sequence[str] = ALLOW, name: str = "secrets") -> DataFrame:
    """``documents`` with ``name``: an array of ``start``, ``rank``, ``end``, ``kind`` of all secrets.

    Start and end count code points, the end is exclusive. ``assign``, ``access``
    and ``hex`` are the leftmost non-overlapping matches of each pattern;
    ``entropy`` adds windows of high entropy in candidates that the allow-list
    does not name. Spans of different kinds may overlap. NULL and empty texts
    have none; repeated rows have the same. Other columns pass through, and
    ``name`` replaces a column of that name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = {kind: match_spans(text, *rule) for kind, rule in KINDS.items()} | {ENTROPY: entropy_spans(text, allow)}
    return documents.withColumn(name, F.array_sort(F.concat(*[_of_kind(kind, spans) for kind, spans in found.items()])))


def scan(documents: DataFrame, allow: Sequence[str] = ALLOW) -> DataFrame:
    """``doc_id``, counts per kind, a digest of the base spans and all spans as text, one row per row."""
    base = F.filter("secrets", lambda x: x["kind"] != ENTROPY)
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    found = with_secrets(documents.select("doc_id", "text"), allow)
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ORDER],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("secrets")).alias("spans"),
    )


def redacted(documents: DataFrame, allow: Sequence[str] = ALLOW, mask: str = MASK) -> DataFrame:
    """``documents`` with every secret in ``text`` replaced by ``mask``; ``n_chars``, if there, follows the text.

    NULL and empty texts stay, repeated rows are masked alike, other columns pass through whatever their names.
    """
    spans = spare(documents, "_secret_spans")
    found = with_secrets(documents, allow, spans)
    pairs = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    out = found.withColumn(spans, merged(pairs)).withColumn("text", replaced(F.col("text"), F.col(spans), mask))
    if "n_chars" in documents.columns:
        length = F.length("text").cast(documents.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return out.drop(spans)
