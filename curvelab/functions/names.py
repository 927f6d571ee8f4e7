"""Class name and ordinal taken from file names.

Fixed values that must equal the reference's behaviour:
  * feature/image files are named ``<class>_<num>.jpg`` (the ordinal sits
    between the last underscore and the ``.jpg`` suffix);
  * the quota-split variant takes the class as everything before the
    character that precedes the first digit of the name.
Names that do not follow these forms give a null class (and null number).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (see module docstring).
CLASS_NUM_PATTERN = r"^(.*)_([0-9]+)[.]jpg$"
FIRST_DIGIT_PATTERN = r"^(\D*)\D\d"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path) -> Column:
    """Last path component."""
    return F.element_at(F.split(_col(path), "/"), -1)


def class_from_first_digit(name) -> Column:
    """Text before the character preceding the first digit; null if none."""
    return F.nullif(F.regexp_extract(_col(name), FIRST_DIGIT_PATTERN, 1), F.lit(""))


def class_and_num(name) -> Column:
    """struct(class_name, num) from ``<class>_<num>.jpg``; nulls when the form is wrong."""
    n = _col(name)
    cls = F.nullif(F.regexp_extract(n, CLASS_NUM_PATTERN, 1), F.lit(""))
    num = F.nullif(F.regexp_extract(n, CLASS_NUM_PATTERN, 2), F.lit("")).try_cast("bigint")
    return F.struct(cls.alias("class_name"), num.alias("num"))


def num_from_name(name) -> Column:
    return class_and_num(name).getField("num")
