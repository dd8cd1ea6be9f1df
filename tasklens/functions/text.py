"""Labels, keys and text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Glyph labels start at this code point and use this many glyphs.
FIRST_GLYPH = 127812
GLYPHS = 50

# Marker text inside habit descriptions, and the project title that names a folder.
STREAK_MARK = "Current streak"
STREAK_PREFIX = "**Current streak:** "
FOLDER_TITLE_LIKE = "folder_map - %"
FOLDER_TITLE_PATTERN = r"folder_map - '(.*)'"

# Fixed value: stands for NULL inside a surrogate key.
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the fields as text joined by '-', with a marker in place of NULL."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def stable_glyph(name: Column | str) -> Column:
    """The same name always gets the same one of the fixed glyphs."""
    bucket = F.conv(F.substring(F.md5(_col(name)), 1, 8), 16, 10).cast("bigint") % GLYPHS
    code_point = F.lpad(F.hex(bucket + FIRST_GLYPH), 8, "0")
    return F.decode(F.unhex(code_point), "UTF-32")


def stable_label(name: Column | str) -> Column:
    return F.concat(stable_glyph(name), F.lit(" "), _col(name))


def clean_content(c: Column | str) -> Column:
    """Drop @labels, squeeze white space, trim."""
    unlabelled = F.regexp_replace(_col(c), "@[^ ]+", "")
    return F.trim(F.regexp_replace(unlabelled, r"\s+", " "))


def streak_text(description: Column | str) -> Column:
    text = _col(description)
    return F.when(text.contains(STREAK_MARK), F.replace(text, F.lit(STREAK_PREFIX), F.lit("")))


def streak_count(streak: Column | str) -> Column:
    """Leading whole number of the streak text."""
    return F.regexp_substr(_col(streak), F.lit(r"^\d+")).try_cast("bigint")


def folder_label(project_name: Column | str) -> Column:
    """Folder name held in the title of a folder-naming project, else NULL."""
    name = _col(project_name)
    return F.when(name.rlike(FOLDER_TITLE_PATTERN), F.regexp_extract(name, FOLDER_TITLE_PATTERN, 1))


def slash_label(*parts: Column | str) -> Column:
    """Numbers joined by '/', such as month/day; NULL when any part is."""
    pieces = []
    for part in parts:
        pieces += [F.lit("/"), _col(part).cast("string")]
    return F.concat(*pieces[1:])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
