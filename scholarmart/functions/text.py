"""Text normalisation, query prefixes, snippets and HTML to text."""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarmart.functions.scalar import ColumnLike, _c, words

# Words that may not end a suggested query.
STOP_WORDS = (
    "de", "en", "la", "el", "a", "para", "con", "y", "o", "del", "al", "los", "las", "un", "una", "por", "como",
)
ACCENTED = "áàâäãéèêëíìîïóòôöõúùûüñç"
PLAIN = "aaaaaeeeeiiiiooooouuuunc"


def fold(text: ColumnLike) -> Column:
    """Lower case without accents; NULL becomes the empty text."""
    return F.translate(F.lower(F.coalesce(_c(text), F.lit(""))), ACCENTED, PLAIN)


def singular(word: Column) -> Column:
    """A word of five letters or more without its plural ending."""
    ending = F.when(word.endswith("es"), F.lit(2)).otherwise(F.lit(1))
    return F.when(word.endswith("s") & (F.length(word) > 4), F.substring(word, F.lit(1), F.length(word) - ending)).otherwise(word)


def search_tokens(*texts: ColumnLike, stop_words: Sequence[str] = STOP_WORDS, stem: bool = True) -> Column:
    """Normalised search tokens of several texts, in order and with repetitions.

    Folded words of letters and digits without plural endings (a light rule in place
    of a full stemmer) and without stop words.
    """
    tokens = F.split(F.concat_ws(" ", *[fold(t) for t in texts]), r"[^\p{L}\p{N}]+")
    if stem:
        tokens = F.transform(tokens, singular)
    return F.filter(tokens, lambda w: ~w.isin("", *stop_words))


def spoken_tokens(*texts: ColumnLike, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Words in lower case with their accents, which a stemmer needs, without stop words."""
    tokens = F.split(F.lower(F.concat_ws(" ", *[_c(t) for t in texts])), r"[^\p{L}\p{N}]+")
    return F.filter(tokens, lambda w: ~w.isin("", *stop_words))


def query_prefixes(text: ColumnLike, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Suggested sub-queries of a query, longest last.

    Prefixes of two or more words that do not end in a stop word; a single word
    gives itself; if every prefix ends in a stop word the whole query is given.
    """

    def expand(w: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1))), lambda i: (i >= 2) & ~F.get(w, i - 1).isin(*stop_words))
        prefixes = F.transform(ends, lambda i: F.array_join(F.slice(w, F.lit(1), i), " "))
        return (
            F.when(F.size(w) <= 1, w)
            .when(F.size(ends) == 0, F.array(F.array_join(w, " ")))
            .otherwise(F.array_distinct(prefixes))
        )

    # the words are bound to a variable; as a plain expression they would be split again for every prefix
    return F.element_at(F.transform(F.array(words(text)), expand), 1)


def sentences(text: ColumnLike) -> Column:
    """The lower-case sentences of a whole text, without empty ones."""
    parts = F.split(F.lower(_c(text)), r"[.!?\n]+")
    squeezed = F.transform(parts, lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    return F.filter(squeezed, lambda p: p != "")


def html_text(html: ColumnLike) -> Column:
    """Readable text of a page: no scripts, styles, comments or tags; blanks squeezed."""
    out = F.regexp_replace(_c(html), r"(?is)<script[^>]*>.*?</script>", " ")
    out = F.regexp_replace(out, r"(?is)<style[^>]*>.*?</style>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(unescaped(out), r"\s+", " "))


def html_title(html: ColumnLike) -> Column:
    title = F.regexp_extract(_c(html), r"(?is)<title>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(unescaped(title), r"\s+", " "))


ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"


def unescaped(text: ColumnLike) -> Column:
    """Text with its numeric and Latin named entities decoded, once each; unknown ones stay as they are. A hard space becomes a blank."""
    names = F.from_json(F.lit(json.dumps({f"&{n};": chr(c) for n, c in name2codepoint.items()} | {"&apos;": "'"})), "map<string,string>")

    def decode(entity: Column) -> Column:
        digits = F.substring(entity, F.lit(3), F.length(entity) - 3)
        hexadecimal = F.lower(F.substring(digits, F.lit(1), F.lit(1))) == "x"
        code = F.when(hexadecimal, F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)).otherwise(digits).cast("int")
        known = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        numeric = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(entity.startswith("&#"), F.when(known, numeric).otherwise(entity)).otherwise(F.coalesce(F.element_at(names, entity), entity))

    t = _c(text)
    found, between = F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0)), F.split(t, ENTITY, -1)
    whole = F.array_join(F.zip_with(between, F.transform(found, decode), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.translate(F.when(F.contains(t, F.lit("&")), whole).otherwise(t), "\u00a0", " ")


def truncated(text: ColumnLike, size: int) -> Column:
    """First ``size`` characters, with dots if something was left out."""
    t = _c(text)
    return F.when(F.char_length(t) > size, F.concat(F.substring(t, 1, size), F.lit("..."))).otherwise(t)


def snippet(text: ColumnLike, term: str | Column, before: int = 40, size: int = 120) -> Column:
    """Text around the first match of ``term`` (case-insensitive); empty without a match."""
    t = _c(text)
    wanted = F.lower(F.lit(term) if isinstance(term, str) else term)
    at = F.when(wanted == "", 0).otherwise(F.instr(F.lower(t), wanted))
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, t.substr(start, F.lit(size))).otherwise(F.lit(""))


def within_one_edit(text: ColumnLike, prefix: str) -> Column:
    """True if some prefix of ``text`` is at most one edit away from ``prefix``."""
    t = _c(text)
    typed = F.lit(prefix)
    sizes = [n for n in (len(prefix) - 1, len(prefix), len(prefix) + 1) if n > 0]
    out = F.lit(False)
    for n in sizes:
        out = out | (F.levenshtein(F.substring(t, 1, n), typed, 1) >= 0)
    return out


def deletion_keys(word: ColumnLike) -> Column:
    """The word and every form of it with one letter taken out.

    Two words within one edit always share such a key, so a fuzzy join becomes an
    equality join.
    """
    w = _c(word)
    cuts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(w), F.lit(1))),
        lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.char_length(w))),
    )
    return F.array_distinct(F.concat(F.array(w), cuts))
