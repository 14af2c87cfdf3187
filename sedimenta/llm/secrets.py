"""Secret scan in built-in functions only: patterns, and sliding-window Shannon entropy per character class.

Base kinds are patterns with a least length. The entropy kinds look at candidate strings, the maximal runs of a class of
characters: a window slides over a candidate while packed counts take in one character and let go of another; the sum
of c*log2(c) follows each change, so a window costs the same at any width. A span reaches from the first window at or
over the threshold to the last one. The allow-list drops whole candidates (UUIDs, paths of words) or cuts candidates at
words of samples and manuals, so that no window reaches over these. Spans inside a base span are not told twice.

Positions are code points, end exclusive. Java's matches are found by splitting: the lengths of matches and of what
stands between them add up to their positions. Everything is at most n*log(n) in a text's length and number of matches:
running totals are taken in log2(n) passes over an array, and no array grows element by element.

Defined results. Null text: as empty, no spans. Repeated rows and null doc_ids are scanned like any other. Extra columns
are ignored by scan() and kept by redact(), whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import fresh

# The base kinds in their order; pattern, group that is measured, least length.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: The same matches, without those that are too short anyway.
_SEARCHED = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"(?<![0-9a-f])[0-9a-f]{24,}"}
#: Class: alphabet, width of the window, bits a character from which a window counts, what else a candidate must hold.
CLASSES = {
    "entropy_hex": ("0123456789abcdefABCDEF", 24, 3.0, (r"[0-9]", r"[a-fA-F]")),
    "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 22, 3.9, (r"[0-9]", r"[a-z]", r"[A-Z]")),
}
#: Candidates that match one of these are no secrets: UUIDs, paths of words.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^/?([a-z]+[/_-])+[a-z]+$",
)
#: Candidates are cut at these: words of manuals, alphabets.
CUT = r"(?i)example|sample|placeholder|changeme|dummy|abcdefghij|0123456789|1234567890"

#: Bits of a packed count, and counts in a long.
_BITS, _PACKED = 6, 10
#: Code points of a block of text from which redact() copies.
_BLOCK = 4096
_names = itertools.count()


def _quoted(text: str) -> str:
    return "r'" + text + "'" if "'" not in text else 'r"""' + text + '"""' if '"' not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, body) -> str:
    """SQL: body(name) with the value under a name."""
    name = f"v{next(_names)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def _running(values: str, join) -> str:
    """SQL: running totals of an array of ints, by doubling steps."""
    a, k, x, i = (f"{c}{next(_names)}" for c in "akxi")
    step = f"shiftleft(1, {k})"
    return _let(
        values,
        lambda v: f"aggregate(sequence(0, cast(floor(log2(greatest(size({v}) - 1, 1))) AS int)), {v}, ({a}, {k}) -> transform({a}, ({x}, {i}) -> CASE WHEN {i} >= {step} THEN {join(x, f'{a}[{i} - {step}]')} ELSE {x} END))",
    )


def _sum(values: str) -> str:
    return _running(values, lambda x, y: f"{x} + {y}")


def _greatest(values: str) -> str:
    return _running(values, lambda x, y: f"greatest({x}, {y})")


def _places(text: str, pattern: str) -> str:
    """SQL: (s, m) of the leftmost non-overlapping matches in a text."""
    p = _quoted(pattern)

    def between(parts: str, found: str) -> str:
        ends = _sum(f"zip_with({found}, slice({parts}, 1, size({found})), (m, g) -> length(g) + length(m))")
        return f"zip_with({found}, {ends}, (m, e) -> named_struct('s', e - length(m), 'm', m))"

    return _let(f"split({text}, {p}, -1)", lambda parts: _let(f"regexp_extract_all({text}, {p}, 0)", lambda found: between(parts, found)))


def _pieces(candidate: str, cut: str) -> str:
    """SQL: (s, m) of what stands between the matches of `cut` in a candidate."""
    p = _quoted(cut)

    def between(parts: str) -> str:
        lengths = f"transform(regexp_extract_all({candidate}, {p}, 0), m -> length(m))"
        ends = _sum(f"zip_with({parts}, concat(array(0), {lengths}), (g, n) -> length(g) + n)")
        return f"zip_with({parts}, {ends}, (g, e) -> named_struct('s', e - length(g), 'm', g))"

    return f"CASE WHEN {candidate} RLIKE {p} THEN {_let(f'split({candidate}, {p}, -1)', between)} ELSE array(named_struct('s', 0, 'm', {candidate})) END"


def _window(piece: str, alphabet: str, width: int, bits: float) -> str:
    """SQL: (first, last), where the windows at or over the threshold begin and end, null without any."""
    gain = "array(" + ",".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(width + 2)) + ")"
    code = [0] * 128
    for k, c in enumerate(alphabet):
        code[ord(c)] = k // _PACKED << 6 | _BITS * (k % _PACKED)
    codes = f"transform(split({piece}, ''), c -> array({','.join(map(str, code))})[ascii(c)])"
    count = lambda p, c: f"cast(shiftright({p}[shiftright({c}, 6)], {c} & 63) & {(1 << _BITS) - 1} AS int)"
    unit = lambda at, c: f"CASE WHEN {at} = shiftright({c}, 6) THEN shiftleft(1L, {c} & 63) ELSE 0L END"
    enough = lambda total: f"{math.log2(width) + 1e-9!r}D - {total} / {width} >= {bits}D"  # noqa: E731  room for the error of added logarithms

    def slide(codes: str) -> str:
        def moved(c: str) -> str:  # in, out: codes, out negative at first; n, o: their counts without the one that leaves
            total = f"acc.sum + {gain}[{c}.n + 1] - {gain}[{c}.n] - CASE WHEN {c}.out < 0 THEN 0D ELSE {gain}[{c}.o + 1] - {gain}[{c}.o] END"
            packed = f"transform(acc.p, (x, at) -> x + {unit('at', f'{c}.in')} - CASE WHEN {c}.out < 0 THEN 0L ELSE {unit('at', f'{c}.out')} END)"
            hot = lambda t: f"i >= {width - 1} AND {enough(t)}"
            return _let(
                total,
                lambda t: f"named_struct('p', {packed}, 'sum', {t}, 'first', CASE WHEN acc.first IS NULL AND {hot(t)} THEN i - {width - 1} ELSE acc.first END, 'last', CASE WHEN {hot(t)} THEN i + 1 ELSE acc.last END)",
            )

        def counted(c: str) -> str:
            own = f"{count('acc.p', f'{c}.in')} - CASE WHEN {c}.in = {c}.out THEN 1 ELSE 0 END"
            left = f"CASE WHEN {c}.out < 0 THEN 0 ELSE {count('acc.p', f'{c}.out')} - 1 END"
            return _let(f"named_struct('in', {c}.in, 'out', {c}.out, 'n', {own}, 'o', {left})", moved)

        step = _let(f"named_struct('in', {codes}[i], 'out', CASE WHEN i < {width} THEN -1 ELSE {codes}[i - {width}] END)", counted)
        zero = f"named_struct('p', array_repeat(0L, {-(-len(alphabet) // _PACKED)}), 'sum', 0D, 'first', cast(null AS int), 'last', cast(null AS int))"
        return f"aggregate(sequence(0, size({codes}) - 1), {zero}, (acc, i) -> {step}, acc -> named_struct('first', acc.first, 'last', acc.last))"

    return f"CASE WHEN length({piece}) >= {width} THEN {_let(codes, slide)} END"


def _run(alphabet: str, least: int) -> str:
    """The pattern of maximal runs of `least` or more characters."""
    inside = "".join("\\" + c if c in "+/-_" else c for c in alphabet)
    return f"(?<![{inside}])[{inside}]{{{least},}}"


def found(documents: DataFrame, to: str, allowed: tuple[str, ...] = ALLOWED, cut: str = CUT) -> DataFrame:
    """documents with a column `to` of base and spans, sorted arrays of (s, kind, e); kind counts BASE, then CLASSES."""
    text = "coalesce(text, '')"
    wide = max(CLASSES.values(), key=lambda c: len(c[0]))[0]
    least = min(BASE["hex"][2], *(c[1] for c in CLASSES.values()))
    long_run = f"{text} RLIKE {_quoted(_run(wide, least).replace(',}', '}'))}"  # hexadecimal runs are runs of the wide class too
    words = " OR ".join(f"contains(w, '{w}')" for w in ("password", "passwd", "secret", "token", "apikey", "api_key"))
    guards = {"assign": f"exists(array(lower({text})), w -> {words})", "access": f"contains({text}, 'AKIA')"}
    none = "cast(array() AS array<struct<s:int,m:string>>)"
    raw = [
        f"'{kind}', CASE WHEN {guards.get(kind, long_run)} THEN {_places(text, _SEARCHED.get(kind, pattern))} ELSE {none} END" for kind,
        (pattern, *_) in BASE.items()
    ]
    raw += [f"'{kind}', CASE WHEN {long_run} THEN {_places(text, _run(c[0], c[1]))} ELSE {none} END" for kind, c in CLASSES.items()]
    rows = documents.withColumn(to, F.expr(f"named_struct({', '.join(raw)})"))

    kinds = []
    for n, (kind, (pattern, group, size)) in enumerate(BASE.items()):
        kept = f"filter(`{to}`.{kind}, x -> length(regexp_extract(x.m, {_quoted(pattern)}, {group})) >= {size})"
        kinds.append(f"'{kind}', transform({kept}, x -> named_struct('s', x.s, 'kind', {n}, 'e', x.s + length(x.m)))")
    for n, (kind, (alphabet, width, bits, needs)) in enumerate(CLASSES.items(), len(BASE)):
        likely = " AND ".join([f"NOT x.m RLIKE {_quoted(p)}" for p in allowed]) or "true"
        pieces = f"flatten(transform(filter(`{to}`.{kind}, x -> {likely}), x -> transform({_pieces('x.m', cut)}, y -> named_struct('s', x.s + y.s, 'm', y.m))))"
        held = " AND ".join(f"x.m RLIKE {_quoted(p)}" for p in needs)
        hot = f"transform(filter({pieces}, x -> {held}), x -> named_struct('s', x.s, 'w', {_window('x.m', alphabet, width, bits)}))"
        kinds.append(f"'{kind}', transform(filter({hot}, x -> x.w.first IS NOT NULL), x -> named_struct('s', x.s + x.w.first, 'kind', {n}, 'e', x.s + x.w.last))")
    rows = rows.withColumn(to, F.expr(f"named_struct({', '.join(kinds)})"))

    base, added = (f"concat({', '.join(f'`{to}`.{k}' for k in some)})" for some in (BASE, CLASSES))
    rows = rows.withColumn(to, F.expr(f"named_struct('base', array_sort({base}), 'every', array_sort(concat({base}, {added})))"))
    # an added span is told unless a base span that starts before or with it ends behind or with it
    ends = _greatest(f"transform(`{to}`.every, x -> CASE WHEN x.kind < {len(BASE)} THEN x.e ELSE -1 END)")
    told = _let(ends, lambda e: f"filter(`{to}`.every, (x, i) -> x.kind < {len(BASE)} OR {e}[i] < x.e)")
    return rows.withColumn(
        to,
        F.expr(f"named_struct('base', `{to}`.base, 'spans', CASE WHEN size(`{to}`.base) IN (0, size(`{to}`.every)) THEN `{to}`.every ELSE {told} END)")
    )


def _told(spans: str) -> Column:
    names = ",".join(f"'{k}'" for k in [*BASE, *CLASSES])
    return F.expr(f"array_join(transform({spans}, x -> concat(element_at(array({names}), x.kind + 1), ':', x.s, ':', x.e)), ',')")


def scan(documents: DataFrame, allowed: tuple[str, ...] = ALLOWED, cut: str = CUT) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added."""
    rows = found(documents.select("doc_id", "text"), "f", allowed, cut)
    counts = [F.expr(f"cast(size(filter(f.base, x -> x.kind = {n})) AS bigint)").alias(f"n_{k}") for n, k in enumerate(BASE)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_told("f.base"), 256).alias("base_sha256"),
        _told("f.spans").alias("spans"),
        (F.size("f.spans") - F.size("f.base")).cast("long").alias("n_added")
    )


def redact(documents: DataFrame, mark: str = "[SECRET]", allowed: tuple[str, ...] = ALLOWED, cut: str = CUT) -> DataFrame:
    """documents with the mark in place of every span in text; overlapping spans become one mark. Other columns stay."""
    to = fresh(documents, "found")
    rows = found(documents, to, allowed, cut)

    def written(ends: str) -> str:  # ends: running maximum of the spans' ends
        heads = f"filter(transform(`{to}`.spans, (x, i) -> CASE WHEN i = 0 OR x.s >= {ends}[i - 1] THEN i END), i -> i IS NOT NULL)"
        return _let(heads, lambda h: _let(f"regexp_extract_all(text, '(?s).{{1,{_BLOCK}}}', 0)", lambda blocks: gaps(ends, h, blocks)))

    def gaps(ends: str, heads: str, blocks: str) -> str:
        begin = f"transform({heads}, (h, j) -> CASE WHEN j = 0 THEN 0 ELSE {ends}[h - 1] END)"
        until = f"transform({heads}, h -> `{to}`.spans[h].s)"
        all_gaps = f"zip_with(concat({begin}, array({ends}[size({ends}) - 1])), concat({until}, array(length(text))), (a, b) -> named_struct('a', a, 'b', b))"
        block = lambda at: f"cast(floor({at} / {_BLOCK}) AS int)"
        piece = f"""CASE WHEN g.a >= g.b THEN ''
          WHEN {block("g.a")} = {block("(g.b - 1)")} THEN substring({blocks}[{block("g.a")}], g.a % {_BLOCK} + 1, g.b - g.a)
          ELSE concat(substring({blocks}[{block("g.a")}], g.a % {_BLOCK} + 1),
            array_join(slice({blocks}, {block("g.a")} + 2, {block("(g.b - 1)")} - {block("g.a")} - 1), ''),
            substring({blocks}[{block("(g.b - 1)")}], 1, (g.b - 1) % {_BLOCK} + 1)) END"""
        return f"array_join(transform({all_gaps}, g -> {piece}), {_quoted(mark)})"

    ends = _greatest(f"transform(`{to}`.spans, x -> x.e)")
    out = f"CASE WHEN size(`{to}`.spans) = 0 THEN text ELSE {_let(ends, written)} END"
    return rows.withColumn("text", F.expr(out)).select(*[F.col(f"`{c}`") for c in documents.columns])
