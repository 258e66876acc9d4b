"""Sections of flattened posting descriptions.

A description is one line in which headings survive as phrases and lists as
bullets. Headings are looked for in a folded copy (no white space, no accents,
lower case) and judged in the original. The vocabulary is a parameter: a table
of (heading, kind); HEADINGS is a short one. Work is done in Arrow batches,
each text on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import each, fold_map, fold_text

# Headings of each kind of section; a longer vocabulary is given as a parameter.
HEADINGS = (
    ("responsibilities", ("responsibilities", "key responsibilities", "job responsibilities", "duties", "what you will do", "job description", "شرح وظایف", "وظایف", "وظایف اصلی", "missions", "aufgaben", "deine aufgaben", "jouw taken", "verantwoordelijkheden")),
    ("requirements", ("requirements", "job requirements", "qualifications", "what we are looking for", "شرایط احراز", "شرایط احراز شغل", "شرایط مورد نیاز", "kualifikasi", "profil recherché", "anforderungen", "dein profil", "vereisten", "functie-eisen")),
    ("skills", ("skills", "required skills", "key skills", "مهارت ها", "vaardigheden", "kennis en vaardigheden", "compétences")),
    ("preferred", ("nice to have", "preferred qualifications", "preferred skills", "is een pré", "wenselijk")),
    ("language", ("languages", "language requirements", "taalvereisten", "talen", "زبان")),
    ("education", ("education", "experience", "تحصیلات", "سن", "جنسیت", "opleiding", "werkervaring", "escolaridade")),
    ("benefits", ("benefits", "what we offer", "perks", "مزایا", "wat bieden wij", "arbeidsvoorwaarden", "o que oferecemos")),
)

# Marks that end a sentence, follow a heading, and begin or divide items.
SENTENCE_END = ".!?;؟۔。！"
AFTER_HEADING = ":：-–—•*·|/→»›"
ITEM_TRIM = " \t\r\n•·-–—*|"
_SEPARATORS = re.compile(r"^[\s:：\-–—•*·.\|/>→»›,،؛;]+")
_BULLETS = re.compile(r"[•·‣▪◦●○⁃∙*]\s*|(?:^|\s)[\-–—]\s+")
_DASHES = re.compile(r"\s+[\-–—]\s+")

# Headings whose wording varies, and their kinds; the company's capital is what tells the first from prose.
VARYING = tuple((re.compile(p), kind) for p, kind in (
    (r"\b(?i:about)\s+[A-Z][\w&.\-]*(?:\s+[A-Z][\w&.\-]*){0,3}\b", "other"),
    (r"\babout\s+(?:us|the\s+company|this\s+(?:role|position|team))\b", "other"),
    (r"(?i)\bequal\s+opportunity\b[^.:\n]{0,40}", "other"),
    (r"(?i)\bprivacy\s+(?:policy|notice|guidelines?)\b", "other"),
    (r"(?i)\bwhy\s+(?:join|work\s+with)\s+us\b", "other"),
    (r"(?i)\b(?:our|who\s+we\s+are|company)\s+(?:mission|story|culture|values|overview)\b", "other"),
    (r"(?i)\bwhat\s+we\s+offer\s+you\b", "benefits"),
))

# Phrases that introduce a skill, words that such a phrase may catch instead, and what joins two skills.
SKILL_PHRASES = tuple(re.compile(p) for p in (
    r"(?:مسلط(?:ه)?|تسلط|آشنا(?:یی)?|آشنا|تجربه|توانایی|مهارت|کارآیی|اطلاع)\s+(?:به|با|در|از)\s+(?P<skill>[^،؛•\n:()\[\]]{2,40})",
    r"(?i)(?:proficient|proficiency|familiar|experience|knowledge|skilled|ability|working knowledge|comfortable|hands-on|solid)\s+(?:in|with|of|using)\s+(?P<skill>[^,;\n:()\[\]]{2,40})",
    r"(?i)(?:menguasai|memahami|pengalaman|kemampuan|terbiasa)\s+(?:dalam|di|pada|untuk)\s+(?P<skill>[^,;\n:()\[\]]{2,40})",
    r"(?i)(?:thanh thao|am hieu|kinh nghiem|ky nang)\s+(?:voi|trong|ve)\s+(?P<skill>[^,;\n:()\[\]]{2,40})",
    r"(?:ფლობს|იცის|გამოცდილება|უნარებობა)\s+(?:ში|თან|ზე)\s+(?P<skill>[^,;\n:()\[\]]{2,40})",
))
NO_SKILL = frozenset((
    "one of", "one or more", "at least", "more than", "less than", "order of", "the use of", "addition to", "any of", "detail", "detail. ", "a range of", "terms of", "line with", "accordance with",
    "the field", "this role", "the role", "our team", "the team", "the company", "the product", "the business", "a minimum of", "the area", "the right", "them", "this", "that", "which", "who", "what", "our", "the", "a", "an",
))
_SKILL_TAIL = re.compile(r"[،؛:•\-–—]+.*$")
_SKILL_JOIN = re.compile(r"\s+(?:و|or|and|atau|یا)\s+")

# Names of languages, and what must stand near one.
LANGUAGES = (
    ("English", ("english", "انگلیسی", "inggris", "tieng anh", "anglais", "inglés")), ("Persian", ("farsi", "persian", "فارسی", "زبان فارسی")), ("Arabic", ("arabic", "عربی", "bhs", "bahasa arab")),
    ("Hebrew", ("hebrew", "עברית")), ("French", ("french", "français", "فرانسه", "francais")), ("German", ("german", "deutsch", "آلمانی", "allemand")), ("Spanish", ("spanish", "español", "اسپانیایی", "espanol")),
    ("Russian", ("russian", "русский", "روسی")), ("Chinese", ("chinese", "mandarin", "چینی", "中文")), ("Turkish", ("turkish", "ترکی استانبولی", "türkçe")), ("Italian", ("italian", "italiano", "ایتالیایی")),
    ("Portuguese", ("portuguese", "português", "پرتغالی")), ("Indonesian", ("indonesian", "bahasa indonesia")), ("Vietnamese", ("vietnamese", "tiếng việt")), ("Georgian", ("georgian", "ქართული")),
    ("Dutch", ("dutch", "nederlands")), ("Japanese", ("japanese", "ژاپنی", "日本語")), ("Korean", ("korean", "کره ای", "한국어")),
)
_LANGUAGE_CUE = re.compile(r"(?i)زبان|language|linguas|baasa|dil|լեզու")
CUE_CHARS = 60

#: Characters of a description that are read, of an item that are kept, and items of a section.
DESCRIPTION_CHARS, ITEM_CHARS, SECTION_ITEMS = 20_000, 600, 40

COLUMNS = ("requirements", "responsibilities", "required_skills_text", "preferred_skills_text", "language_requirements_text")
HEADING = "struct<kind:string,start:int,end:int,text:string>"
SECTIONS = ", ".join([f"{c} string" for c in COLUMNS] + ["section_count int", "headings array<string>"])


@dataclass(frozen=True)
class Heading:
    kind: str
    start: int
    end: int


class Vocabulary:
    """Headings folded and compiled; of several that fit, the longest is taken. A Latin one must not continue a word."""

    def __init__(self, headings: Iterable[tuple[str, Iterable[str]]] = HEADINGS):
        self.kinds = {fold_text(h): kind for kind, names in headings for h in names}
        by_length = sorted(self.kinds, key=lambda k: (-len(k), k))
        latin = "|".join(re.escape(k) for k in by_length if k.isascii())
        other = "|".join(re.escape(k) for k in by_length if not k.isascii())
        self.patterns = [re.compile(p) for p in ((rf"(?<![a-z0-9])(?:{latin})" if latin else ""), other) if p]

    def find(self, text: str) -> list[Heading]:
        """The headings of text in order, none over another; of those that begin together the longest."""
        folded, places = fold_map(text)
        found = [Heading(kind, m.start(), m.end()) for pattern, kind in VARYING for m in pattern.finditer(text)]
        for pattern in self.patterns:
            for m in pattern.finditer(folded):
                start, end = places[m.start()], places[m.end() - 1] + 1
                if stands_alone(text, start, end):
                    found.append(Heading(self.kinds[m.group()], start, end))
        out: list[Heading] = []
        for h in sorted(found, key=lambda h: (h.start, -h.end)):
            if not out or h.start >= out[-1].end:
                out.append(h)
        return out


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] is a heading there: at the end, before a separator, or between the end of a sentence and a capital or figure."""
    rest = text[end:].lstrip()
    if not rest or rest[0] in AFTER_HEADING:
        return True
    before = text[:start].rstrip()
    return (not before or before[-1] in SENTENCE_END) and (rest[0].isupper() or rest[0].isdigit())


def items_of(body: str) -> list[str]:
    """A section's items: by bullets; where there are none, by dashes between blanks."""
    body = _SEPARATORS.sub("", body).strip()
    for pattern in (_BULLETS, _DASHES):
        items = [p.strip(ITEM_TRIM) for p in pattern.split(body) if p.strip()]
        if len(items) > 1:
            break
    else:
        items = [body.strip(ITEM_TRIM)]
    return [i for i in items if i]


def skills_of(text: str) -> list[str]:
    """Skills that a phrase introduces. The search goes on inside what was caught, which may introduce another."""
    out = []
    for pattern in SKILL_PHRASES:
        m = pattern.search(text)
        while m:
            skill = _SKILL_JOIN.split(_SKILL_TAIL.sub("", m["skill"]).strip(ITEM_TRIM), maxsplit=1)[0].strip()
            if 2 <= len(skill) <= 60 and skill.lower() not in NO_SKILL:
                out.append(skill)
            m = pattern.search(text, m.start("skill"))
    return out


def languages_of(text: str) -> list[str]:
    """Languages of which the first mention of a name stands near a word for language, in alphabetical order."""
    low = text.lower()

    def wanted(name: str) -> bool:
        at = low.find(name)
        return at >= 0 and _LANGUAGE_CUE.search(low[max(0, at - CUE_CHARS) : at + CUE_CHARS]) is not None

    return sorted(language for language, names in LANGUAGES if any(map(wanted, names)))


#: Where a section's items, and the skills named in them, go by its kind; other kinds give only skills.
_ROUTES = {
    "preferred": ("preferred_skills_text", "preferred_skills_text"),
    "skills": ("required_skills_text", "required_skills_text"),
    "requirements": ("requirements", "required_skills_text"),
    "education": ("requirements", "required_skills_text"),
    "responsibilities": ("responsibilities", "required_skills_text"),
}


def sections_of(description: str | None, vocabulary: Vocabulary, chars: int = DESCRIPTION_CHARS) -> tuple:
    """The five columns, the number of headings, and the headings of a description; without requirements, skills are taken from all of it."""
    text = (description or "")[:chars]
    headings = vocabulary.find(text)
    held: dict[str, list[str]] = {c: [] for c in COLUMNS}
    for i, h in enumerate(headings):
        stop = headings[i + 1].start if i + 1 < len(headings) else len(text)
        if h.kind == "language":
            held["language_requirements_text"] += languages_of(text[h.start : stop])
            continue
        items = items_of(text[h.end : stop])
        to, skills_to = _ROUTES.get(h.kind, (None, "required_skills_text"))
        if to:
            held[to] += items
        held[skills_to] += skills_of(" ".join(items))
    if not held["requirements"]:
        held["required_skills_text"] += skills_of(text)

    def shown(items: list[str]) -> str | None:
        once: dict[str, str] = {}
        for i in items:
            once.setdefault(i.lower(), i)
        return "\n".join(f"- {i[:ITEM_CHARS]}" for i in list(once.values())[:SECTION_ITEMS]) or None

    return (*(shown(held[c]) for c in COLUMNS), len(headings), [text[h.start : h.end] for h in headings])


def find_headings(text: Column, headings: Iterable = HEADINGS) -> Column:
    """array<struct<kind, start, end, text>>; null gives null."""
    v = Vocabulary(headings)
    return each(f"array<{HEADING}>", lambda t: [{"kind": h.kind, "start": h.start, "end": h.end, "text": t[h.start : h.end]} for h in v.find(t)])(text)


def split_items(text: Column) -> Column:
    return each("array<string>", items_of)(text)


def skill_phrases(text: Column) -> Column:
    return each("array<string>", skills_of)(text)


def required_languages(text: Column) -> Column:
    return each("array<string>", languages_of)(text)


def sections(text: Column, headings: Iterable = HEADINGS) -> Column:
    """struct of COLUMNS, section_count and headings; null and empty texts have none of them."""
    v = Vocabulary(headings)

    @F.pandas_udf(SECTIONS)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sections_of(t, v) for t in texts], columns=[c.split()[0] for c in SECTIONS.split(", ")])

    return run(text)
