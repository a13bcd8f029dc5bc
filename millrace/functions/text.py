"""Text predicates and rewrites as Column expressions; all stay in the JVM.

Character classes are written out, because Java's shorthands differ from what the
rules mean: a word character is ``[\\p{L}\\p{N}_]``, a letter of a word
``[\\p{L}\\p{Nl}\\p{No}]``. Predicates are false on blank text, never null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .kernels import EMOJI_SPANS, strip_diacritics

EMOJI_RANGES = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in EMOJI_SPANS)
#: All Unicode white space.
SPACES = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"[\p{L}\p{N}_]"
NOT_BEFORE, NOT_AFTER = rf"(?<!{WORD})", rf"(?!{WORD})"

# Patterns and word lists of the rules.
DOMAIN_ENDS = "com|net|org|vn|store|info|biz|io"
ACCENTED = "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵ"
PLAIN_VIETNAMESE = (
    "hang dep tot khong ko k chua rat nhanh giao dung shop san pham mua cho minh toi va nhung duoc cung voi nay kia dau gia re mau vai "
    "chat luong nhan xau lam cam on hai long that ma thi la cua em anh chi roi qua sach moi cu hop hoi vua nho lon ngon mem nong lanh chuan "
    "dong goi tang kich thuoc size ve tu nhieu it hon sau truoc dang cac con"
).split()
COMMON_ENGLISH = (
    "the a is are was were it this that good great nice very quality product fast delivery shipping love like bad best recommend recommended "
    "thanks thank you thx works work worth price perfect excellent amazing happy seller item received arrived package well and for with of in "
    "on my so not but too really just as at be have has had i we they he she its cheap fine okay comfortable fit fits small big beautiful"
).split()
KEPT_PUNCTUATION = r""".,!?:;'"()\-/%+&@#$=*…"""

URL_PATTERN = (
    r"(?iu)https?://(?U:\S)+|www\.(?U:\S)+|"
    rf"(?<!{WORD})[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?\.(?:{DOMAIN_ENDS})(?:\.{WORD}{{2,3}})?"
    rf"(?:(?:/(?U:\S)*)(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))|(?!{WORD}))"
)
PHONE_PATTERN = r"(?<!\p{Nd})(?:\+84|0)(?:(?U:[\s.\-])?\p{Nd}){8,10}(?!\p{Nd})"


def matches(c: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit(pattern)), F.lit(False))


def trim_all(c: Column) -> Column:
    """Strips all Unicode white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def blank(c: Column) -> Column:
    return ~matches(c.cast("string"), r"(?U)\S")


def none_if_blank(c: Column) -> Column:
    return F.when(~blank(c), c)


def squeeze_spaces(c: Column) -> Column:
    """One kind of newline, single spaces, no blank lines, nothing at the ends."""
    steps = [(r"\r\n?", "\n"), (r"(?U)[^\S\n]+", " "), (" ?\n ?", "\n"), ("\n{2,}", "\n")]
    return trim_all(reduce(lambda x, s: F.regexp_replace(x, *s), steps, c))


def word_count(c: Column) -> Column:
    """Number of runs between white space; 0 for blank text."""
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\S++")), F.lit(0))


def contains_url(c: Column) -> Column:
    return matches(c, URL_PATTERN)


def contains_phone(c: Column) -> Column:
    return matches(c, PHONE_PATTERN)


def is_advertising(c: Column) -> Column:
    return contains_url(c) | contains_phone(c)


def is_emoji_only(c: Column) -> Column:
    return matches(F.regexp_replace(c, r"(?U)\s", ""), rf"^[{EMOJI_RANGES}]+$")


def is_symbol_only(c: Column) -> Column:
    """Not blank, and without any letter or digit."""
    return ~blank(c) & ~matches(c, r"[\p{L}\p{N}]")


def has_vowel(c: Column) -> Column:
    return matches(c, rf"(?iu)[aeiouy{ACCENTED.replace('đ', '')}]")


def has_accent(c: Column) -> Column:
    return matches(c, f"(?iu)[{ACCENTED}]")


def is_short(c: Column, most: int) -> Column:
    """One to ``most`` words; a long text is read no further than that."""
    return matches(c, rf"(?U)\A\s*+\S++(?:\s++\S++){{0,{most - 1}}}+\s*+\z") if most > 0 else F.lit(False)


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), F.array().cast("array<string>"))


def alternation(terms: list[str]) -> str:
    """A pattern for any of the terms as whole words, longest first, in any case."""
    body = "|".join(rf"\Q{t}\E" for t in sorted(terms, key=len, reverse=True))
    return f"(?iu){NOT_BEFORE}(?:{body}){NOT_AFTER}"


def contains_term(c: Column, terms: list[str]) -> Column:
    return matches(c, alternation(terms)) if terms else F.lit(False)


def trie(terms: list[str]) -> str:
    """A pattern for any of the terms in which common beginnings are tried once."""
    by_first: dict[str, list[str]] = {}
    for t in sorted(set(terms)):
        if t:
            by_first.setdefault(t[0], []).append(t[1:])
    body = "|".join(rf"\Q{c}\E{trie(rest)}" for c, rest in by_first.items())
    return f"(?:{body}){'?' if '' in terms else ''}" if body else ""


_LETTER = r"[\p{L}\p{Nl}\p{No}]"


def _in_list(words: list[str]) -> str:
    return f"(?<!{_LETTER}){trie(words)}(?!{_LETTER})"


def language(c: Column, least_share: float = 0.95) -> Column:
    """``vi``, ``drop`` or ``suspect`` by letters and two word lists; later tests run only where earlier ones leave it open."""
    low = F.lower(c)
    found = F.regexp_count(low, F.lit(_LETTER + "++"))
    return (
        F.when(has_accent(c), "vi")
        .when(~matches(c, r"\p{L}"), "vi")
        .when(matches(c, r"[\p{L}&&[^\p{IsLatin}]]|[ªº]"), "drop")
        .when(matches(low, _in_list(PLAIN_VIETNAMESE)), "vi")
        .when(~matches(low, _in_list(COMMON_ENGLISH)), "vi")
        .when((found >= 3) & (F.regexp_count(low, F.lit(_in_list(COMMON_ENGLISH))) / F.greatest(found, F.lit(1)) >= least_share), "drop")
        .otherwise("suspect")
    )


def drop_special(c: Column) -> Column:
    """Blanks out characters that carry no meaning; an underscore stays between two letters or digits."""
    loose = F.regexp_replace(c, r"(?<![\p{L}\p{N}])_|_(?![\p{L}\p{N}])", " ")
    return F.regexp_replace(loose, rf"(?U)[^\p{{L}}\p{{N}}\s{KEPT_PUNCTUATION}\p{{Sc}}\p{{Mn}}\p{{Mc}}\p{{Me}}_]", " ")


def squeeze_punctuation(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"([!?,:;\-*=+/])\1+", "$1"), r"\.{3,}", "...")


_MARKED = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
_BASE = "a" * 17 + "e" * 11 + "i" * 5 + "o" * 17 + "u" * 11 + "y" * 5 + "d"


def strip_accents(c: Column) -> Column:
    """Vietnamese letters without tone, hook and bar; other letters stay."""
    return F.translate(c, _MARKED + _MARKED.upper(), _BASE + _BASE.upper())


_PLAIN = {c: p for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if len(p := strip_diacritics(c)) == 1 and p != c}


def strip_marks(c: Column) -> Column:
    """Latin letters without any marks, as ``kernels.strip_diacritics`` has them."""
    return F.translate(c, "".join(_PLAIN), "".join(_PLAIN.values()))


def markdown_cell(c: Column) -> Column:
    text = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\|", r"\\|")
    return trim_all(F.regexp_replace(text, r"(?U)\s+", " "))


def replaced_list(pairs: Column) -> Column:
    """``a -> b; c -> d`` from an array of (a, b) structs."""
    return F.array_join(F.transform(pairs, lambda p: F.concat_ws(" -> ", p["a"], p["b"])), "; ")
