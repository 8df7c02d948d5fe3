"""Label and name expressions. Everything here is a built-in Spark expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from pixelweave import fixed, schemas

# All characters Python's ``str.strip`` removes; they lie below U+3001.
_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_label(c: Column | str) -> Column:
    """Lower-case, then strip every kind of white space at both ends."""
    return F.btrim(F.lower(_col(c)), F.lit(_WHITESPACE))


def first_label(detections: Column | str) -> Column:
    """Label of the first detection; ``unknown`` without one, ``none`` if it is null."""
    d = _col(detections)
    label = norm_label(F.coalesce(F.get(d, F.lit(0))["label"], F.lit("None")))
    return F.when(F.size(d) > 0, label).otherwise(F.lit(fixed.UNKNOWN_LABEL))


def canonical_name(idx: Column | str) -> Column:
    """Canonical image name of an enumeration index."""
    return F.format_string(fixed.IMAGE_NAME_FORMAT, _col(idx))


def chunk_path(split: Column | str, chunk_id: Column | str, kind: str = "images") -> Column:
    """Relative location of one chunk of a split."""
    name = F.format_string(fixed.CHUNK_NAME_FORMATS[kind], _col(chunk_id))
    return F.concat_ws("/", _col(split), name)


def basename(c: Column | str) -> Column:
    """Part of a path after the last slash."""
    return F.substring_index(_col(c), "/", -1)


def label_lookup(classes: Sequence) -> dict:
    """Class to index; a class named twice keeps its last index."""
    return {label: idx for idx, label in enumerate(classes)}


def _literal_array(values: Sequence, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def label_index(c: Column | str, classes: Sequence, strict: bool = True) -> Column:
    """Index of a label in the class list. An unknown label fails, or is null if lax."""
    lookup = label_lookup(classes)
    known = F.array(*[F.lit(v) for v in lookup])
    index = _literal_array(list(lookup.values()), "int")
    label = _col(c)
    slot = F.array_position(known, label).cast("int") - 1
    found = F.get(index, slot)
    if not strict:
        return found
    complaint = F.concat(
        F.lit("label not in class list: "), F.coalesce(label.cast("string"), F.lit("NULL"))
    )
    return F.coalesce(found, F.raise_error(complaint).cast("int"))


def label_of(idx: Column | str, classes: Sequence) -> Column:
    """Label of a class index; null outside the list."""
    return F.get(F.array(*[F.lit(v) for v in classes]), _col(idx).cast("int"))


def one_hot(idx: Column | str, n: int) -> Column:
    """Float target of length ``n`` with a single one; without classes it is empty."""
    if n < 0:
        raise ValueError("the number of classes must not be negative")
    i = _col(idx)
    if n == 0:
        return F.array().cast("array<float>")
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda k: (k == i).cast("int").cast("float")
    )


def clamp_end(start: Column | str, size: int, total: Column | str) -> Column:
    """End of a slice of ``size`` rows, clamped to the number of rows."""
    return F.least(_col(start) + F.lit(size), _col(total))


def parse_label_map(c: Column | str) -> Column:
    """JSON object of label to index, as a map."""
    return F.from_json(_col(c), schemas.LABEL_MAP)


def parse_label_list(c: Column | str) -> Column:
    """Labels of a label file, which is an object with ``labels`` or a bare list.

    Any other text gives null, which callers treat as "no labels": strict JSON only, in
    double quotes and with nothing after the value.
    """
    # The parser stops at the end of the first value. As a field with another one behind it,
    # a value that something follows is no longer well-formed.
    text = F.concat(F.lit('{"v":'), _col(c), F.lit(',"end":1}'))

    def parsed(kind: str) -> Column:
        row = F.from_json(text, f"struct<v:{kind},end:int>", {"allowSingleQuotes": "false"})
        return F.when(row["end"] == 1, row["v"])

    return F.coalesce(parsed("struct<labels:array<string>>")["labels"], parsed("array<string>"))


def has_prefix(c: Column | str, prefix: str = fixed.BATCH_PREFIX) -> Column:
    """True where the name starts with ``prefix``."""
    return F.startswith(_col(c), F.lit(prefix))
