"""Text expressions: tokens, list entries, document names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate tokens. Everything else ("-", "/",
# currency signs, digits) stays inside a token.
TOKEN_DELIMITERS = r"""[\t\n\r\f,.:;?!\[\]'"()& ]+"""

# List entries lose every leading and trailing character up to U+0020, which is
# more than Spark's trim removes.
_EDGE_CONTROLS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def tokens(text: Column) -> Column:
    """Lower-cased pieces of ``text``; the first and last may be empty."""
    return F.split(F.lower(text), TOKEN_DELIMITERS)


def list_entry(line: Column) -> Column:
    """One line of a stop-word list or dictionary as it is compared with tokens."""
    return F.lower(F.regexp_replace(line, _EDGE_CONTROLS, ""))


def doc_name(path: Column) -> Column:
    """``folder/name.txt`` as ``folder.name``; every ".txt" in the name is removed.

    File paths in Spark's metadata are URL-encoded ("+" is literal there).
    """
    parts = F.split(path, "/")
    folder = F.url_decode(F.replace(F.element_at(parts, -2), F.lit("+"), F.lit("%2B")))
    file = F.url_decode(F.replace(F.element_at(parts, -1), F.lit("+"), F.lit("%2B")))
    return F.concat_ws(".", folder, F.replace(file, F.lit(".txt"), F.lit("")))
