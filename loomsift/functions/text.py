"""String normalisation and identity, as Column expressions (a pandas UDF only where Unicode tables are needed)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomsift.schema import SOURCE_ID, TIER

# Letters with diacritics and their plain forms.
ACCENTS = {
    "a": "áàảãạăắằẳẵặâấầẩẫậ",
    "e": "éèẻẽẹêếềểễệ",
    "i": "íìỉĩị",
    "o": "óòỏõọôốồổỗộơớờởỡợ",
    "u": "úùủũụưứừửữự",
    "y": "ýỳỷỹỵ",
    "d": "đ",
}


def collapsed(c: Column) -> Column:
    """White space runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != ""))


def plain_title(t: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower()
    return " ".join("".join(c if c == "_" or c.isalnum() or c.isspace() else " " for c in plain).split())


def normalized_title(c: Column | str) -> Column:
    """NFKD without combining marks, lower case, punctuation to spaces, collapsed."""

    def titles(s: pd.Series) -> pd.Series:
        return s.map(plain_title, na_action="ignore")

    return F.pandas_udf(titles, "string")(c)


def straight(c: Column) -> Column:
    """Curly quotes and long dashes become plain ones; white space is collapsed; digits and case stay."""
    return collapsed(F.translate(F.coalesce(c, F.lit("")), "‘’“”–—", "''\"\"--"))


#: All characters whose case folding isn't their lower case, or whose lower case hangs on others, and many that are neither:
#: a class that is quick to look for.
FOLDING = r"[\xb5\xdf\x{100}-\x{10ffff}]"


def quote_form(c: Column) -> Column:
    """``straight`` by full Unicode case folding; only texts that need it go through Python."""

    def folded(s: pd.Series) -> pd.Series:
        return s.map(str.casefold, na_action="ignore")

    plain = straight(c)
    return F.coalesce(F.pandas_udf(folded, "string")(F.when(plain.rlike(FOLDING), plain)), F.lower(plain))


def contains_quote(source: Column, quote: Column) -> Column:
    """Whether a non-empty quote stands in a non-empty source; a blank quote does."""
    filled = (F.length(F.coalesce(source, F.lit(""))) > 0) & (F.length(F.coalesce(quote, F.lit(""))) > 0)
    return filled & F.contains(quote_form(source), quote_form(quote))


def arxiv_id(c: Column) -> Column:
    """arxiv:NNNN.NNNNN of an id or URL, without version; null if it is none."""
    t = F.trim(c)
    of_url = F.regexp_extract(t, r"abs/(\d{4}\.\d{4,5})(?:v\d+)?/?$", 1)
    bare = F.regexp_replace(F.regexp_replace(t, r"(?i)^arxiv:", ""), r"v\d+$", "")
    found = F.concat(F.lit("arxiv:"), F.when(of_url != "", of_url).otherwise(bare))
    return F.when(found.rlike(SOURCE_ID["arxiv"]), found)


def source_of_id(c: Column) -> Column:
    """The source an id belongs to by its form: null if it has none (it is rejected, not guessed)."""
    t = F.trim(c)
    return F.when(t.rlike(SOURCE_ID["ieee"]), F.lit("ieee")).when(arxiv_id(t).isNotNull(), F.lit("arxiv"))


def canonical_id(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike(SOURCE_ID["ieee"]), t).otherwise(arxiv_id(t))


def uid(source: Column, source_id: Column) -> Column:
    """source:id, or the id where it has that prefix."""
    return F.when(F.startswith(source_id, F.concat(source, F.lit(":"))), source_id).otherwise(F.concat_ws(":", source, source_id))


def uid_source(c: Column) -> Column:
    return F.substring_index(c, ":", 1)


def default_tier(source: Column) -> Column:
    """The source's tier; an unknown source is an error."""
    known = F.create_map(*[F.lit(x) for kv in TIER.items() for x in kv])
    tier = F.try_element_at(known, source)
    return F.when(tier.isNull(), F.raise_error(F.concat(F.lit("no tier for source "), F.coalesce(source, F.lit("null")))).cast("int")).otherwise(tier)


def slug(c: Column) -> Column:
    """Lower-case ASCII words joined by hyphens."""
    accented, plain = "".join(ACCENTS.values()), "".join(k * len(v) for k, v in ACCENTS.items())
    return F.regexp_replace(F.regexp_replace(F.translate(F.lower(c), accented, plain), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def entropy(c: Column) -> Column:
    """Shannon entropy in bits a character; 0 for an empty string."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    n = F.size(chars).cast("double")
    share = F.transform(F.array_distinct(chars), lambda x: F.size(F.filter(chars, lambda y: y == x)) / n)
    return F.when(F.length(c) == 0, F.lit(0.0)).otherwise(-F.aggregate(share, F.lit(0.0), lambda a, p: a + p * F.log2(p)))


def masked(c: Column) -> Column:
    """Ends of a match and its length, never the whole."""
    n = F.length(c)
    tail = F.concat(F.lit("(len="), n.cast("string"), F.lit(")"))
    return F.when(n <= 8, F.concat(F.substring(c, 1, 2), F.lit("…"), tail)).otherwise(F.concat(F.substring(c, 1, 4), F.lit("…"), F.right(c, F.lit(2)), tail))


def short_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 12)
