"""WKT as far as the functions need it: points and bounding boxes, in SQL text."""

from __future__ import annotations

from .cells import leaf_steps
from .formula import Formula

# --- fixed values: the text grammar -------------------------------------------
NUMBER = r"[-+]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
# -------------------------------------------------------------------------------
POSITION = rf"({NUMBER})\\s+({NUMBER})(?:\\s+{NUMBER}){{0,2}}"
POINT = rf"^\\s*(?i:POINT)\\s*(?i:ZM|Z|M)?\\s*\\(\\s*{POSITION}\\s*\\)\\s*$"


def _escaped(pattern: str) -> str:
    """Braces doubled, for use inside a formula text."""
    return pattern.replace("{", "{{").replace("}", "}}")


s2_cell_id_from_point = Formula(
    "s2_cell_id_from_point",
    {"wkt": "string"},
    "bigint",
    "CASE WHEN {wkt} IS NULL THEN NULL WHEN NOT {known} THEN 0L ELSE {leaf} END",
    [
        {
            "lon": f"try_cast(regexp_extract({{wkt}}, '{_escaped(POINT)}', 1) AS DOUBLE)",
            "lat": f"try_cast(regexp_extract({{wkt}}, '{_escaped(POINT)}', 2) AS DOUBLE)",
        },
        *leaf_steps(),
    ],
)


def shape(wkt: str) -> str:
    """The text with positions folded to p, position lists to L, lists of those to A, then B."""
    text = f"regexp_replace(upper({wkt}), '{POSITION.replace('eE', 'E')}', 'p')"
    text = f"regexp_replace({text}, '\\\\s+', '')"
    text = f"regexp_replace({text}, '^POINT(?:ZM|Z|M)?\\\\(p\\\\)$', 'O')"
    text = f"regexp_replace({text}, '(?<=[,(])POINT(?:ZM|Z|M)?\\\\(p\\\\)', 'G')"
    text = f"regexp_replace({text}, '\\\\(p(,p)*\\\\)', 'L')"
    text = f"regexp_replace({text}, '\\\\(L(,L)*\\\\)', 'A')"
    text = f"regexp_replace({text}, '\\\\(A(,A)*\\\\)', 'B')"
    text = (
        f"regexp_replace({text}, "
        "'(?:(?:LINESTRING|MULTIPOINT)(?:ZM|Z|M)?L|(?:POLYGON|MULTILINESTRING|MULTIPOINT)(?:ZM|Z|M)?A"
        "|MULTIPOLYGON(?:ZM|Z|M)?B)', 'G')"
    )
    return text


# Collections may hold collections, so deep at most; a deeper one is an error.
_NESTED = 8
_COLLECTION = "GEOMETRYCOLLECTION(?:ZM|Z|M)?\\\\(G(?:,G)*\\\\)"


def is_geometry(wkt: str) -> str:
    text = shape(wkt)
    for _ in range(_NESTED):
        text = f"regexp_replace({text}, '{_COLLECTION}', 'G')"
    deeper = f"raise_error('geometry collections are nested more than {_NESTED} deep')"
    return f"exists(array(coalesce({text}, '')), t -> t RLIKE '^(O|G)$' OR t RLIKE '{_COLLECTION}' AND CAST({deeper} AS BOOLEAN))"


def bounds(wkt: str) -> str:
    """Struct (lat_lo, lat_hi, lon_lo, lon_hi) of a geometry; NULL for text that is none."""
    xs = f"transform(regexp_extract_all({wkt}, '{POSITION}', 1), c -> CAST(c AS DOUBLE))"
    ys = f"transform(regexp_extract_all({wkt}, '{POSITION}', 2), c -> CAST(c AS DOUBLE))"
    return (
        f"CASE WHEN {is_geometry(wkt)} THEN named_struct("
        f"'lat_lo', array_min({ys}), 'lat_hi', array_max({ys}), "
        f"'lon_lo', array_min({xs}), 'lon_hi', array_max({xs})) END"
    )
