"""Scalar text functions, Column to Column. White space is ASCII throughout, which all engines agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\x0B\f\r]"


def let(value: Column, body) -> Column:
    """body of a value that is worked out once; what a lambda takes from outside is worked out again at each of its calls."""
    return F.get(F.transform(F.array(value), body), 0)


def strip_html(c: Column) -> Column:
    """Without scripts and tags."""
    return F.regexp_replace(F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>", ""), r"<[^>]+>", "")


def strip_comments(c: Column) -> Column:
    """Without //, /* */ and # comments; a // in an address counts as one, as it always has."""
    return F.regexp_replace(c, r"(?msd)(//.*?$|/\*.*?\*/|#.*?$)", "")


def squash_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def b64_segments(c: Column) -> Column:
    """Decoded base64 runs of 20 characters and more with right padding, if printable and over 5 characters long."""
    runs = F.regexp_extract_all(c, F.lit(r"[A-Za-z0-9+/]{20,}={0,2}"), F.lit(0))
    body = lambda x: F.rtrim(x, F.lit("="))
    padded = F.filter(runs, lambda x: F.length(x) % 4 == 0)
    text = F.transform(padded, lambda x: F.make_valid_utf8(F.call_function("try_to_binary", F.rpad(body(x), ((F.length(body(x)) + 3) / 4).cast("int") * 4, "="), F.lit("base64")).cast("string")))
    clean = F.transform(text, lambda x: F.replace(x, F.lit("�"), F.lit("")))
    return F.filter(clean, lambda x: (F.length(x) > 5) & ~x.rlike(r"[\p{Cc}\p{Cf}\p{Co}\p{Cs}\p{Zl}\p{Zp}]"))


def unicode_abuse(c: Column, share: float = 0.05) -> Column:
    """Whether more than a share of the characters are format, control, private-use or unassigned ones."""
    odd = F.length(F.regexp_replace(c, r"[^\p{Cf}\p{Cc}\p{Co}\p{Cn}]", ""))
    return F.coalesce(odd > F.length(c) * share, F.lit(False))


def preprocess(c: Column) -> Column:
    """Without markup and comments, white space squashed, followed by the decoded base64 segments of the raw text."""
    return F.when(c.isNotNull(), F.concat_ws(" ", squash_ws(strip_comments(strip_html(c))), b64_segments(c)))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def norm_key(c: Column, length: int = 80) -> Column:
    return F.substring(squash_ws(F.lower(c)), 1, length)


def fmt_ts(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    return F.format_string("%d:%02d", F.floor(whole / 60), whole % 60)


def playlist_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"list=([a-zA-Z0-9_-]+)", 1), F.lit(""))


def unfence(c: Column) -> Column:
    """The content of the first ``` fence, or the text itself."""
    inner = F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)```", 1)
    return F.when(inner != "", inner).otherwise(F.trim(c))


def parse_llm_array(c: Column, element: str) -> Column:
    """The array of structs in a model's answer; null for anything else."""
    return F.from_json(unfence(c), f"array<{element}>")


def claim_spec(c: Column) -> Column:
    """(bundle, signature) of bundle:signature, or of a bare signature."""
    parts = F.split(c, ":", 2)
    return F.when(F.contains(c, F.lit(":")), F.struct(parts[0].alias("bundle"), parts[1].alias("signature"))).otherwise(F.struct(F.lit(None).cast("string").alias("bundle"), c.alias("signature")))


def status_symbol(c: Column) -> Column:
    return F.when(c == "FOUND", "Y").when(c == "PARTIAL", "~").when(c == "ABSENT", "-").otherwise(".")


def status_word(c: Column) -> Column:
    """Four characters or more for each status of a grid."""
    return F.when(c == "FOUND", "FOUND").when(c == "PARTIAL", "PART").when(c == "ABSENT", "---").when(c == "PENDING", "...").otherwise("?")


def first_of(c: Column, markers: tuple[str, ...]) -> Column:
    """The first marker, in lexicon order, that the text contains."""
    return F.get(F.filter(F.array(*map(F.lit, markers)), lambda m: F.contains(c, m)), 0)


def bucketize(c: Column, edges: list[tuple[float, str]], above: str) -> Column:
    """The name of the first edge that a number is below; null counts as 0."""
    out = None
    for edge, name in edges:
        out = F.when(F.coalesce(c, F.lit(0)) < edge, name) if out is None else out.when(F.coalesce(c, F.lit(0)) < edge, name)
    return out.otherwise(above)
