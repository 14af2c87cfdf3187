"""Text functions as column expressions (no Python at run time). Each keeps null as null unless it says otherwise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes. Odd spaces become a space, control characters go, WS is what strip() takes off.
ODD_SPACES = r"\x{00A0}\x{200B}\x{200C}\x{200D}\x{FEFF}"
CONTROLS = r"\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}"
WS = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Scripts that are counted by character.
CJK = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"

# Thresholds.
REPEATS, LINE_LENGTH = 3, 80
PDF_SIGNAL, IMAGE_SIGNAL, OCR_SIGNAL, JSON_WORDS, LANGUAGE_LEAST, LANGUAGE_SAMPLE = 50, 30, 50, 30, 20, 2000
META_LENGTH = 300


def strip(c: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(c, rf"\A[{WS}]+|[{WS}]+\z", "")


def remove_control_chars(c: Column) -> Column:
    """Odd spaces become spaces; then control characters but tab, line feed and carriage return go."""
    return F.regexp_replace(F.regexp_replace(c, f"[{ODD_SPACES}]", " "), f"[{CONTROLS}]", "")


def collapse_whitespace(c: Column) -> Column:
    """Runs of blanks become one, three or more line feeds two; then each line and the whole are stripped. Not idempotent."""
    c = F.regexp_replace(F.regexp_replace(c, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n")
    return strip(F.array_join(F.transform(F.split(c, "\n", -1), strip), "\n"))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def remove_repeated_lines(c: Column, least: int = REPEATS, longest: int = LINE_LENGTH) -> Column:
    """Without the short lines that stand `least` times or more; blank and long lines stay."""

    def often(s: Column) -> Column:
        """Lines that stand as far as `least` - 1 places on in sorted order as well."""
        n = F.size(s)
        ahead = F.slice(s, least, F.greatest(n - least + 1, F.lit(0)))
        pairs = F.filter(
            F.zip_with(ahead, F.slice(s, 1, F.greatest(n - least + 1, F.lit(0))), lambda x, y: F.when(x == y, x)),
            lambda x: x.isNotNull() & (x != "") & (F.length(x) <= longest)
        )
        return F.array_distinct(pairs)

    def kept(lines: Column) -> Column:
        repeated = _let(F.array_sort(F.transform(lines, strip)), often)
        return _let(
            repeated,
            lambda r: F.when(F.size(r) == 0, F.array_join(lines, "\n")).otherwise(F.array_join(F.filter(lines, lambda x: ~F.array_contains(r, strip(x))), "\n"))
        )

    return _let(F.split(c, "\n", -1), kept)


def line_count(c: Column) -> Column:
    return F.size(F.split(c, "\n", -1))


def universal_newlines(c: Column) -> Column:
    """Carriage returns, alone or before a line feed, become line feeds."""
    return F.regexp_replace(c, r"\r\n?", "\n")


def decode_text(content: Column) -> tuple[Column, Column]:
    """Text of bytes, as UTF-8 or else Latin-1, and the name of the encoding."""
    valid = F.is_valid_utf8(content.cast("string"))
    text = F.when(valid, content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    return universal_newlines(text), F.when(valid, F.lit("utf-8")).otherwise(F.lit("latin-1"))


def words(c: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(c, f"[{WS}]+", -1), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def word_count_cjk(c: Column) -> Column:
    """Words, and each character of scripts without spaces once more."""
    return F.size(words(c)) + F.regexp_count(c, F.lit(f"[{CJK}]"))


def row_to_text(cells: list[tuple[str, Column]], separator: str = " | ") -> Column:
    """'column: value' of each cell that is not null, blank or nan, in order."""
    made = [F.when(v.isNotNull() & (strip(v) != "") & (F.lower(v) != "nan"), F.concat(F.lit(f"{k}: "), v)) for k, v in ((k, v.cast("string")) for k, v in cells)]
    return F.array_join(F.array_compact(F.array(*made)), separator)


def feature_text(layer: Column, attributes: Column) -> Column:
    """'capa: layer | name: value' of a map of attributes, without null and blank ones; entries in the map's order."""
    kept = F.filter(F.map_entries(attributes), lambda e: e["value"].isNotNull() & (strip(e["value"]) != ""))
    return F.array_join(F.concat(F.array(F.concat(F.lit("capa: "), layer)), F.transform(kept, lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), " | ")


# Patterns of categories in a path's segments.
CATEGORY_PATTERNS = (r"fen[oó]meno[\s_-]*([123])", r"^f([123])[_\s-]")


def category_from_path(path: Column, patterns: tuple[str, ...] = CATEGORY_PATTERNS) -> Column:
    """The category of the first segment that names one; null if none does."""

    def of(segment: Column) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract(segment, f"(?iu){p}", 1), F.lit("")) for p in patterns])

    return F.get(F.filter(F.transform(F.split(path, "/"), of), lambda x: x.isNotNull()), F.lit(0)).cast("int")


def category_top_folder(path: Column) -> Column:
    """The category that the first segment starts with; 0 if none."""
    return F.coalesce(F.nullif(F.regexp_extract(F.get(F.split(path, "/"), F.lit(0)), r"^[Ff]([123])_", 1), F.lit("")).cast("int"), F.lit(0))


def source_org(path: Column) -> Column:
    """The second of more than two segments, else the first."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0)))


def tileset_root(path: Column) -> Column:
    """The parent of the innermost folder `tiles`, else the file's folder; '.' for the root."""
    tiles = F.regexp_extract(path, r"(?i)^(?:(.*)/)?tiles/.*$", 1)
    own = F.regexp_extract(path, r"^(.*)/[^/]+$", 1)
    root = F.when(path.rlike(r"(?i)^(?:.*/)?tiles/.*$"), tiles).otherwise(own)
    return F.when(root == "", ".").otherwise(root)


#: A whole string that is an address, a date, a number, a hash, a UUID, a type or path, a file name.
JUNK = (
    r"https?://\S+",
    r"\d{4}-\d{2}-\d{2}(?:[T ]\S*)?",
    r"[\d\s.,%+-]+",
    r"[0-9a-f]{16,}",
    r"[0-9a-f]{8}-[0-9a-f]{4}-\S+",
    r"\w+/[\w.+-]+",
    r"\S+\.(?:pdf|json|html?|jpe?g|png|pbf|csv|xlsx)",
)


def is_junk(c: Column) -> Column:
    return strip(c).rlike(r"(?iuU)\A(?:" + "|".join(JUNK) + r")\n?\z")


#: Language codes of one OCR tool as those of another.
OCR_LANGUAGES = {"spa": "es", "eng": "en"}


def ocr_languages(codes: Column, names: dict[str, str] = OCR_LANGUAGES) -> Column:
    """'spa+eng' as ['es', 'en']; unknown codes stay, none at all means ['es']."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    parts = F.filter(F.transform(F.split(codes, r"\+"), strip), lambda x: x != "")
    mapped = F.transform(parts, lambda x: F.coalesce(F.try_element_at(table, x), x))
    return F.when(F.size(mapped) > 0, mapped).otherwise(F.array(F.lit("es")))


def normalise_listed(c: Column) -> Column:
    """A line of a list of paths: without white space and quotes around, with single backslashes."""
    return F.replace(F.regexp_replace(strip(c), r'\A"+|"+\z', ""), F.lit("\\\\"), F.lit("\\"))


def slashes(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))
