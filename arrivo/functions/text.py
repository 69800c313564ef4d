"""Text expressions: title case as Python's ``str.title``, whitespace strip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of letters and runs of non-letters; each letter run is capitalised.
# ``initcap`` only splits on spaces, so it leaves ``EE.UU`` as ``Ee.uu``.
_RUNS = r"(\p{L}+|[^\p{L}]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Python ``str.title()``: upper the first letter of each letter run, lower the rest."""
    runs = F.regexp_extract_all(_col(c).cast("string"), F.lit(_RUNS), 1)
    return F.array_join(
        F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1 << 30)))),
        "",
    )


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind (Unicode blanks and separators too)."""
    return F.regexp_replace(_col(c).cast("string"), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def clean_text(c) -> Column:
    """Strip then title case; NULL stays NULL (the reference turned it into 'Nan')."""
    return title_case(strip_ws(c))
