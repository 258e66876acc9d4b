"""Text cleaning, folding, chunking and language codes.

Built-in expressions where they can say it; entity tables, markup and Unicode
decomposition need Arrow batches of Python. Nulls stay null.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose content is no text.
_SILENT = {"script", "style", "template"}

# The codes of a translation model by language; English needs none.
FLORES = (
    ("en", None), ("zh", "zho_Hans"), ("zh-cn", "zho_Hans"), ("zh-tw", "zho_Hant"), ("fa", "pes_Arab"), ("ko", "kor_Hang"), ("uk", "ukr_Cyrl"), ("es", "spa_Latn"), ("ru", "rus_Cyrl"), ("ne", "nep_Deva"),
    ("is", "isl_Latn"), ("sr", "srp_Cyrl"), ("kk", "kaz_Cyrl"), ("tr", "tur_Latn"), ("ar", "arb_Arab"), ("hy", "hye_Armn"), ("fr", "fra_Latn"), ("pt", "por_Latn"), ("de", "deu_Latn"), ("it", "ita_Latn"),
    ("nl", "nld_Latn"), ("pl", "pol_Latn"), ("cs", "ces_Latn"), ("sk", "slk_Latn"), ("hu", "hun_Latn"), ("ro", "ron_Latn"), ("bg", "bul_Cyrl"), ("el", "ell_Grek"), ("sv", "swe_Latn"), ("da", "dan_Latn"),
    ("no", "nob_Latn"), ("fi", "fin_Latn"), ("et", "est_Latn"), ("lv", "lav_Latn"), ("lt", "lit_Latn"), ("id", "ind_Latn"), ("ms", "msa_Latn"), ("vi", "vie_Latn"), ("th", "tha_Thai"), ("ja", "jpn_Jpan"),
    ("hi", "hin_Deva"), ("bn", "ben_Beng"), ("ta", "tam_Taml"), ("te", "tel_Telu"), ("ur", "urd_Arab"), ("he", "heb_Hebr"), ("ka", "kat_Geor"), ("az", "aze_Latn"), ("uz", "uzb_Latn"), ("ky", "kir_Cyrl"),
    ("mn", "mon_Cyrl"), ("sq", "sqi_Latn"), ("ca", "cat_Latn"), ("eu", "eus_Latn"), ("gl", "glg_Latn"), ("hr", "hrv_Latn"), ("sl", "slv_Latn"), ("fil", "tgl_Latn"), ("tl", "tgl_Latn"), ("af", "afr_Latn"),
    ("bs", "bos_Latn"), ("so", "som_Latn"), ("cy", "cym_Latn"), ("ga", "gle_Latn"), ("mt", "mlt_Latn"), ("lb", "ltz_Latn"), ("co", "cos_Latn"), ("fy", "fry_Latn"), ("su", "sun_Latn"), ("ha", "hau_Latn"),
    ("yo", "yor_Latn"), ("ig", "ibo_Latn"), ("sw", "swh_Latn"), ("km", "khm_Khmr"), ("lo", "lao_Laoo"), ("si", "sin_Sinh"), ("my", "mya_Mymr"), ("am", "ethi_Ethi"), ("gu", "guj_Gujr"), ("kn", "kan_Knda"),
    ("ml", "mal_Mlym"), ("pa", "pan_Guru"),
)

# Code-point ranges that decide a language, in order (kana before hangul before Han).
SCRIPTS = (
    ("ja", "぀", "ヿ"), ("ko", "ᄀ", "ᇿ"), ("ko", "가", "힯"), ("zh", "㐀", "䶿"), ("zh", "一", "鿿"), ("hy", "԰", "֏"), ("hy", "ﬓ", "ﬗ"), ("ka", "Ⴀ", "ჿ"),
    ("ka", "Ა", "Ჿ"), ("ka", "ⴀ", "⴯"), ("am", "ሀ", "፿"), ("my", "က", "႟"), ("km", "ក", "៿"), ("lo", "຀", "໿"), ("si", "඀", "෿"),
)
#: Texts shorter than the first are not guessed at; a description of the second length or more is asked instead of the title.
LEAST_CHARS, LEAST_DESCRIPTION = 10, 60

#: Words that run through a language's texts; for scripts that several languages share, the language with most of them is taken.
FUNCTION_WORDS = (
    ("en", ("the", "and", "of", "to", "in", "is", "that", "with", "for", "was")),
    ("de", ("der", "die", "und", "das", "ein", "nicht", "mit", "von", "sich", "des")),
    ("fr", ("le", "la", "les", "et", "des", "une", "que", "dans", "est", "pour")),
    ("es", ("el", "los", "las", "una", "por", "con", "para", "del", "que", "como")),
    ("it", ("il", "di", "che", "per", "della", "sono", "gli", "non", "una", "con")),
    ("pt", ("o", "os", "uma", "para", "com", "dos", "que", "mais", "da", "na")),
    ("nl", ("het", "een", "van", "dat", "voor", "met", "zijn", "niet", "aan", "op")),
)

_STRIP_CHARS = "\u200c\u200f\u200e\u00ad\u200b"


def norm_skill(text: Column) -> Column:
    """Lower case, white space collapsed; punctuation stays."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def _collapsed(text: str) -> str:
    return " ".join(text.split())


def repaired(text: str) -> str:
    """text with UTF-8 that was read as Windows-1252 or Latin-1 read again, where that explains all of it; other damage stays."""
    if not any("\u0080" <= c <= "\u00ff" or c in "\u20ac\u2122\u0153" for c in text):
        return text
    for code in ("cp1252", "latin-1"):
        try:
            return text.encode(code).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
    return text


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.silent: list[str] = []

    def handle_starttag(self, tag, attrs) -> None:
        if tag in _SILENT:
            self.silent.append(tag)

    def handle_endtag(self, tag) -> None:
        if self.silent and self.silent[-1] == tag:
            self.silent.pop()

    def handle_data(self, data) -> None:
        if not self.silent:
            self.parts.append(data)


_AMPERSAND = re.compile(r"&(?!#[0-9]+;|#[xX][0-9a-fA-F]+;)([A-Za-z][A-Za-z0-9]*;)?")


def marked(markup: str) -> tuple[str, str]:
    """markup in which each & that begins no reference closed by a semicolon is a mark, and the mark: a character that markup does not hold and, of the first 32, no reference gives."""
    mark = next(c for c in map(chr, range(0xFDD0, 0x110000)) if c not in markup)
    return _AMPERSAND.sub(lambda m: m[0] if m[1] in html5 else mark + m[0][1:], markup), mark


def html_text(markup: str, closed: bool = False) -> str:
    """The text of markup, its pieces one space apart, without scripts and styles; references are read as browsers do, or, if closed, only with their semicolon."""
    markup, mark = marked(markup) if closed else (markup, "&")
    p = _Text()
    p.feed(markup)
    p.close()
    return _collapsed(repaired(" ".join(p.parts).replace(mark, "&")))


def each(kind: str, use) -> Callable[[Column], Column]:
    """A column function that calls use on every text of a batch; null stays null."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else use(t))

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return lambda text: F.pandas_udf(run, kind)(text)


def clean_plain(text: Column) -> Column:
    """Entities decoded, misread UTF-8 repaired, white space collapsed; null and empty stay as they are."""
    return each("string", lambda t: _collapsed(repaired(html.unescape(t))))(text)


def clean_html(text: Column, closed: bool = False) -> Column:
    """html_text(); null and empty stay as they are."""
    return each("string", lambda t: html_text(t, closed))(text)


class _Folded(dict):
    """What each character folds to: nothing for white space and invisible marks, else its base letters in lower case."""

    def __missing__(self, c: str) -> str:
        out = "" if c.isspace() or c in _STRIP_CHARS else "".join(p.lower() for p in unicodedata.normalize("NFD", c) if not unicodedata.combining(p))
        self[c] = out
        return out


_FOLDED = _Folded()


def fold_text(text: str) -> str:
    return "".join(map(_FOLDED.__getitem__, text))


def fold_map(text: str) -> tuple[str, list[int]]:
    """fold_text(), and for each of its characters the place in text that it comes from."""
    pieces = [_FOLDED[c] for c in text]
    return "".join(pieces), [i for i, p in enumerate(pieces) for _ in p]


def fold(text: Column) -> Column:
    return each("string", fold_text)(text)


_BOUNDARY = re.compile(r"(?<=[。！？.!?；;])\s+|\n{2,}")


def chunks_of(text: str, most: int) -> list[str]:
    """text cut at ends of sentences and blank lines and packed into chunks of at most `most` characters; a longer sentence is cut at a blank in its second half, or anywhere."""
    out, held = [], ""
    for piece in filter(None, (p.strip() for p in _BOUNDARY.split(text))):
        if len(piece) <= most:
            if held and len(held) + 1 + len(piece) > most:
                out.append(held)
                held = piece
            else:
                held = f"{held} {piece}" if held else piece
            continue
        out.append(held)
        held = ""
        while piece:
            cut = len(piece)
            if cut > most:
                cut = piece.rfind(" ", most // 2, most)
                cut = most if cut < 0 else cut
            out.append(piece[:cut].strip())
            piece = piece[cut:]
    return [c for c in (*out, held) if c]


def split_chunks(text: Column, most: int) -> Column:
    """chunks_of() as an array; null gives null, empty text no chunk."""
    return each("array<string>", lambda t: chunks_of(t, most))(text)


def flores(language: Column) -> Column:
    """The translation model's code of a language, of a regional one else its base's; null for English and for what is not known."""
    known = F.create_map(*[F.lit(x) for code, name in FLORES if name for x in (code, name)])
    own = F.lower(language)
    return F.coalesce(F.try_element_at(known, own), F.try_element_at(known, F.substring_index(own, "-", 1)))


def script_language(text: Column) -> Column:
    """The first language of SCRIPTS of which the text holds a character."""
    return F.coalesce(*[F.when(text.rlike(f"[{low}-{high}]"), code) for code, low, high in SCRIPTS])


def detection_text(title: Column, description: Column) -> Column:
    """The description where it is long enough, else the title, else the description."""
    return F.when(F.length(description) >= LEAST_DESCRIPTION, description).otherwise(F.coalesce(F.nullif(title, F.lit("")), description))


def detect_language(text: Column) -> Column:
    """By script; else, in texts that are not short, the language with most function words, the first of equals; null where none is found."""
    scripted = script_language(text)
    words = F.split(F.lower(text), r"(?U)[^\w]+")


    def found(of: tuple[str, ...]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*of)))

    counts = [found(of) for _, of in FUNCTION_WORDS]
    most = F.greatest(*counts)
    by_words = F.coalesce(*[F.when((n == most) & (n > 0), code) for (code, _), n in zip(FUNCTION_WORDS, counts, strict=True)])
    bare = F.length(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))
    return F.when(bare > 0, F.coalesce(scripted, F.when(bare >= LEAST_CHARS, by_words)))
