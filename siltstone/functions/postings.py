"""Column functions over posting titles, descriptions and amounts; all built-in expressions.

A table of (code, pattern) is ordered: the first pattern found names the code.
Null and empty inputs give null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered patterns of education levels.
EDUCATION = (
    ("phd", r"\b(ph\.?d|doctorat|doctorate|doctorado|dr\.|promotion|doktortitel|دکتری|دکترا|\bs3\b)\b"),
    ("master", r"\b(master'?s?|magister|msc|m\.s\.|mba|maestr[ií]a|bac\s*\+\s*5|postgraduate|graduate degree|کارشناسی[\s‌]*ارشد|فوق[\s‌]*لیسانس|\bs2\b)\b"),
    ("bachelor", r"\b(bachelor'?s?|licence|licenciatura|bac\s*\+\s*[34]|bsc|b\.s\.|b\.a\.|grado universitario|undergraduate|degree in|college degree|university degree|کارشناسی|لیسانس|\bs1\b|sarjana)\b"),
    ("high_school", r"\b(high\s*school|baccalaur[eé]at|\bbac\b|secundaria|bachiller|bachillerato|ged|secondary education|دیپلم|abitur|realschulabschluss|matura|\bsma\b|\bsmk\b)\b"),
    ("associate", r"\b(associate'?s?|dut|bts|t[eé]cnico superior|foundation degree|college diploma|کاردانی|فوق[\s‌]*دیپلم|ausbildung|fachhochschulreife|\bd3\b)\b"),
    ("professional_certification", r"\b(pmp|cpa|cfa|chartered|barreau|certification professionnelle)\b"),
    ("none", r"\b(no degree|sin estudios|aucun dipl[oô]me|sans dipl[oô]me|no formal education)\b"),
)

# Ordered patterns of experience levels, years of experience, and the least years of each level.
EXPERIENCE = (
    ("executive", r"\b(c-level|chief executive|ceo|cto|cfo|coo|cmo|vice president|\bvp\b|president|geschäftsführer|vorstand|مدیر[\s‌]*عامل|مدیر[\s‌]*ارشد)\b"),
    ("principal", r"\b(principal|staff\s+(?:engineer|developer)|distinguished|director|directeur|leiter|abteilungsleiter|bereichsleiter|مدیر[\s‌]*کل|رئیس)\b"),
    ("lead", r"\b(team\s*lead|lead|tech\s*lead|chef d'[eé]quipe|architect|manager|líder|teamleiter|سرپرست|لید)\b"),
    ("senior", r"\b(senior|\bsr\.?\b|s[eé]nior|avanc[eé]|experto|ارشد)\b"),
    ("mid", r"\b(mid[-\s]?level|intermediate|confirm[eé]|medior)\b"),
    ("junior", r"\b(junior|\bjr\.?\b|d[eé]butant)\b"),
    ("entry", r"\b(entry[-\s]?level|trainee|stagiaire|intern|internship|pr[aá]cticas|practicante|fresh graduate|apprentice|werkstudent|praktikant|کارآموز)\b"),
)
EXPERIENCE_YEARS = r"(?:(\d+)\s*(?:to|-)\s*)?(\d+)\+?\s*(?:years?|yrs?|ans|a[nñ]os?)\s*(?:of)?\s*(?:exp|experience|d'exp[eé]rience|de experiencia)"
YEARS_LEVELS = ((12, "principal"), (8, "lead"), (5, "senior"), (3, "mid"), (1, "junior"))

# Patterns of places of work.
HYBRID = r"\b(hybrid|hybride|h[ií]brido|semi[-\s]?presencial|mixto)\b"
REMOTE = r"\b(remote|teletrabajo|t[eé]l[eé]travail|home[-\s]?office|work from home|wfh|telework)\b"
REMOTE_GLOBAL = r"\b(worldwide|globally|anywhere|global|international)\b"
ON_SITE = r"\b(on[-\s_]?site|presencial|sur[-\s]?site|in[-\s]?office|in[-\s]?person)\b"

# Patterns for and against visa sponsorship and relocation.
VISA = (
    r"\b(visa\s*sponsorship\s*(?:is\s*)?(?:available|provided|offered|supported)|we\s*(?:can\s*)?sponsor\s*visas?|will\s*sponsor\s*visa|sponsoring\s*visas?)\b",
    r"\b(no\s*visa\s*sponsorship|visa\s*sponsorship\s*(?:is\s*)?not\s*available|cannot\s*sponsor|unable\s*to\s*sponsor|not\s*providing\s*visa|must\s*have\s*valid\s*work\s*authorization|no\s*sponsorship)\b",
)
RELOCATION = (
    r"\b(relocation\s*(?:assistance|package|support|allowance|bonus|provided|covered|offered)|we\s*(?:will|can)\s*relocate|help\s*with\s*relocation)\b",
    r"\b(no\s*relocation|relocation\s*(?:assistance\s*)?(?:is\s*)?not\s*(?:provided|available|offered)|cannot\s*relocate)\b",
)

# Noise at the end of titles, seniority at their beginning, titles of test postings, a board's boilerplate.
TITLE_NOISE = r"\s*(?:\([^)]*\)|\[[^\]]*\]|(?:\s*[-|–,]\s*)(?:remote|onsite|hybrid|full-?time|part-?time|urgent|immediate).*$)$"
SENIORITY = r"^(?:senior|sr\.?|junior|jr\.?|lead|principal|staff|intern|internship|stagiaire|associate|head\s+of|director\s+of|vp\s+of|assistant)\s+"
TEST_TITLE = r"^\s*test\s*\d*\s*$"
BOILERPLATE = r"Please mention the word \*\*.*?\*\* and tag .*?\. This is a beta feature to avoid spam applican\w*\.?"

# Ordered patterns of years of experience as a range, an open range and a least number; the bound on years.
YEARS_UNIT = r"(?:years?|yrs?|a[nñ]os?|ans?|jahre?(?:n)?|سال|tahun)"
YEARS_WORD = r"(?:experience|exp|d'exp[eé]rience|de\s+experiencia|berufserfahrung|erfahrung|سابقه|تجربه|pengalaman)"
YEARS_LEAST = r"(?:at\s+least|minimum|min\.?|more\s+than|>|\+|al\s+menos|m[ií]nimo|minimo|au\s+moins|mindestens|mind\.?|حداقل|minimal)"
YEARS_RANGE = rf"\b(\d{{1,2}})\s*(?:-|to|a|al|à|bis|تا|sampai)\s*(\d{{1,2}})\s*(?:\+)?\s*{YEARS_UNIT}(?:\s+(?:of\s+)?(?:relevant\s+|direct\s+)?{YEARS_WORD})?\b"
YEARS_OPEN = rf"\b(\d{{1,2}})\s*\+\s*{YEARS_UNIT}(?:\s+(?:of\s+)?(?:relevant\s+|direct\s+)?{YEARS_WORD})?\b"
YEARS_MIN = rf"\b(?:{YEARS_LEAST}\s*)?(\d{{1,2}})\s*(?:\+)?\s*{YEARS_UNIT}\s+(?:of\s+)?(?:relevant\s+|direct\s+)?{YEARS_WORD}\b"
MOST_YEARS = 30

# Ordered patterns of roles in titles, and of management in texts.
ROLES = (
    ("executive", r"\b(?:c[etfomio]o|chief\s+\w+\s+officer|vice\s+president|vp\b|managing\s+director|executive\s+director|partner|founder|director\s+general|gerente\s+general|geschäftsführer|vorstand|مدیر[\s‌]*عامل|مدیر[\s‌]*ارشد)\b"),
    ("director", r"\b(?:director(?:\s+of)?|head\s+of|group\s+head|directeur|leiter|abteilungsleiter|bereichsleiter|مدیر[\s‌]*کل|رئیس)\b"),
    ("manager", r"\b(?:manager|general\s+manager|supervisor|superintendent|gerente|encargado|responsable|gruppenleiter|مدیر|مسئول)\b"),
    ("team_lead", r"\b(?:team\s+lead|tech\s+lead|lead\s+(?:engineer|developer|designer|analyst|architect|consultant)|lead|líder|chef\s+d'équipe|teamleiter|سرپرست|لید)\b"),
    ("individual_contributor", r"\b(?:intern|junior|entry\s*level|associate|specialist|engineer|developer|analyst|consultant|coordinator|officer|staff|principal|senior|desarrollador|ingeniero|analista|especialista|stagiaire|développeur|ingénieur|\w*entwickler|\w*ingenieur|sachbearbeiter|berater|کارشناس|مهندس|توسعه[\s‌]*دهنده|برنامه[\s‌]*نویس|طراح|کارآموز)\b"),
)
MANAGEMENT = r"\b(?:manage\s+(?:a\s+)?team|direct\s+reports|supervise\s+(?:staff|team|employees)|leading\s+a\s+team\s+of|dirigir\s+(?:un\s+)?equipo|gestionar\s+(?:un\s+)?equipo|teamführung|führung\s+von\s+mitarbeitern|مدیریت\s+تیم|سرپرستی\s+تیم)\b"

# Ordered patterns of work schedules.
SCHEDULES = (
    ("night_shift", r"\b(?:night\s*shift|third\s*shift|graveyard\s*shift|overnights?|turno\s+de\s+noche|nocturno|nachtschicht|travail\s+de\s+nuit|شیفت\s*شب)\b"),
    ("weekend", r"\b(?:weekend\s*shift|weekends?\s*only|weekend\s*work|fines\s+de\s+semana|wochenendarbeit|آخر\s*هفته)\b"),
    ("rotational", r"\b(?:rotational\s*shift|rotating\s*shift|shift\s*work|turno\s+rotativo|schichtarbeit|travail\s+posté|شیفت\s*چرخشی)\b"),
    ("flexible", r"\b(?:flexible\s*(?:working\s*)?(?:hours|schedule)|flexitime|flextime|horario\s+flexible|gleitzeit|horaires\s+flexibles|ساعت\s*کاری\s*منعطف|ساعات\s*کاری\s*منعطف)\b"),
    ("standard_day", r"\b(?:day\s*shift|standard\s*business\s*hours|9\s*(?:am)?\s*(?:-|to)\s*5\s*(?:pm)?|monday\s*(?:-|to)\s*friday|lunes\s+a\s+viernes|montag\s+bis\s+freitag|du\s+lundi\s+au\s+vendredi|شنبه\s+تا\s+چهارشنبه)\b"),
)

# Names of pay periods.
PAY_PERIODS = (
    ("annual", "yearly"), ("annually", "yearly"), ("per year", "yearly"), ("per annum", "yearly"), ("year", "yearly"), ("per hour", "hourly"), ("hour", "hourly"),
    ("per month", "monthly"), ("month", "monthly"), ("per week", "weekly"), ("week", "weekly"), ("per day", "daily"), ("day", "daily"),
)
ALLOWED_PERIODS = ("hourly", "daily", "weekly", "monthly", "yearly")


def has(text: Column, pattern: str) -> Column:
    """Whether the pattern is found, in any case and any script; false for null."""
    return F.coalesce(text.rlike("(?iU)" + pattern), F.lit(False))


def first_match(text: Column, table: Iterable[tuple[str, str]]) -> Column:
    out = None
    for code, pattern in table:
        out = F.when(has(text, pattern), code) if out is None else out.when(has(text, pattern), code)
    return out


def education_level(text: Column) -> Column:
    return first_match(text, EDUCATION)


def experience_level(title: Column, text: Column, years: Column | None = None) -> Column:
    """By the title; else by the years that a source states; else by those that the text asks for, the lower of a range; else by the text's words."""
    found = [F.nullif(F.regexp_extract(text, "(?iU)" + EXPERIENCE_YEARS, k), F.lit("")) for k in (1, 2)]

    def of(n: Column) -> Column:
        level = F.when(n.isNull(), None)
        for least, code in YEARS_LEVELS:
            level = level.when(n >= least, code)
        return level.otherwise("entry")

    stated = [] if years is None else [of(years.cast("double"))]
    return F.coalesce(first_match(title, EXPERIENCE), *stated, of(F.coalesce(*found).try_cast("double")), first_match(text, EXPERIENCE))


def experience_range(text: Column) -> tuple[Column, Column]:
    """The least and the most years of experience that the text asks for (int); null where it names none.

    A range goes before an open one (5+), that before a least number; the first
    of its kind counts, unless it is out of order or over MOST_YEARS.
    """

    def number(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, "(?iU)" + pattern, group).try_cast("int")

    low, high = number(YEARS_RANGE, 1), number(YEARS_RANGE, 2)
    both = F.coalesce((low <= high) & (high <= MOST_YEARS), F.lit(False))
    least = F.coalesce(*[F.when(n <= MOST_YEARS, n) for n in (number(YEARS_OPEN, 1), number(YEARS_MIN, 1))])
    return F.when(both, low).otherwise(least), F.when(both, high)


def seniority(title: Column, text: Column) -> tuple[Column, Column]:
    """The role that the title names, and whether it manages people (null: unknown).

    A lead manages only if the text says so. A title that names no role is a
    manager's where the text says so; an absent or empty title has no role.
    """
    manages, named = has(text, MANAGEMENT), first_match(title, ROLES)
    role = F.when(F.length(title) > 0, F.coalesce(named, F.when(manages, "manager")))
    flag = F.when(role.isin("executive", "director", "manager"), True).when((role == "team_lead") & manages, True).when(role == "individual_contributor", False)
    return role, flag


def work_schedule(text: Column) -> Column:
    return first_match(text, SCHEDULES)


def remote_type(text: Column) -> Column:
    return F.when(has(text, HYBRID), "hybrid").when(has(text, REMOTE) & has(text, REMOTE_GLOBAL), "remote_global").when(has(text, REMOTE), "remote_country").when(has(text, ON_SITE), "on_site")


def stance(text: Column, patterns: tuple[str, str]) -> Column:
    """True, false, or null where the text says neither; what speaks for it is looked for first."""
    return F.when(has(text, patterns[0]), True).when(has(text, patterns[1]), False)


def clean_title(title: Column) -> Column:
    """Up to three pieces of noise at the end go, then what is no word, space, - / or &."""
    for _ in range(3):
        title = F.trim(F.regexp_replace(title, "(?iu)" + TITLE_NOISE, ""))
    return F.trim(F.regexp_replace(F.regexp_replace(title, r"(?U)[^\w\s\-/&]", ""), r"(?U)\s+", " "))


def core_title(cleaned: Column) -> Column:
    return F.trim(F.regexp_replace(cleaned, "(?iu)" + SENIORITY, ""))


def without_boilerplate(description: Column) -> Column:
    """The description without a board's notice to applicants."""
    return F.trim(F.regexp_replace(F.coalesce(description, F.lit("")), "(?isu)" + BOILERPLATE, ""))


def is_non_job(title: Column, description: Column) -> Column:
    """A test posting, or under 15 characters of description beside the boilerplate."""
    return F.coalesce(title.rlike("(?iu)" + TEST_TITLE), F.lit(False)) | (F.length(without_boilerplate(description)) < 15)


def pay_period(text: Column) -> Column:
    """One of the allowed periods, or null."""
    own = F.lower(F.trim(text))
    names = F.create_map(*[F.lit(x) for pair in PAY_PERIODS for x in pair])
    found = F.coalesce(F.try_element_at(names, own), own)
    return F.when(found.isin(*ALLOWED_PERIODS), found)


def european_amount(text: Column) -> Column:
    """A positive amount, or null. Of two kinds of separator the last is the decimal one; a single kind is, unless three digits follow its last."""
    d = F.regexp_replace(text, r"[^0-9,.\-]", "")
    both = d.contains(",") & d.contains(".")
    last = F.regexp_extract(d, r"([,.])[^,.]*$", 1)
    one = F.regexp_replace(d, r"[,.](?=.*[,.])", "")
    plain = F.when(both & (last == ","), F.translate(d, ",.", ".")).when(both, F.translate(d, ",", "")).when(one.rlike(r"[,.][^,.]{3}$"), F.regexp_replace(one, r"[,.]", "")).otherwise(F.regexp_replace(one, ",", "."))
    amount = plain.try_cast("double")
    return F.when(amount > 0, amount)


def relative_day(text: Column, today: Column) -> Column:
    """The day that an age in English or Hebrew stands for, minutes and hours being today; null if the text names none."""
    pattern = r"(?i)(\d+)\s*(minute|hour|day|week|month|year)s?\s+ago"
    n = F.regexp_extract(text, pattern, 1).try_cast("int")
    unit = F.lower(F.regexp_extract(text, pattern, 2))
    days = F.when(unit.isin("minute", "hour"), 0).when(unit == "day", n).when(unit == "week", 7 * n).when(unit == "month", 30 * n).when(unit == "year", 365 * n)
    return F.date_sub(today, F.coalesce(days, _hebrew_age(text)))


# Beginnings of units in Hebrew and their days; a day is also a word of its own.
HEBREW_UNITS = (("דקו", 0), ("שע", 0), ("ימ", 1), ("שבוע", 7), ("חודש", 30), ("שנה", 365))
HEBREW_DAY = "יום"


def _hebrew_age(text: Column) -> Column:
    """Days of the first number and the word behind it, where the text holds a Hebrew letter; a number alone is days."""
    pattern = r"(\d+)\s*(\S+)?"
    n, unit = F.regexp_extract(text, pattern, 1).try_cast("int"), F.regexp_extract(text, pattern, 2)
    days = F.when(unit == HEBREW_DAY, n)
    for begin, size in HEBREW_UNITS:
        days = days.when(unit.startswith(begin), n * size)
    return F.when(text.rlike("[\u05d0-\u05ea]"), days.otherwise(n))


# The formats of days that pages print, in the order in which they are tried.
DAY_FORMATS = ("yyyy-M-d", "yyyy/M/d", "d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy")


def parse_day(text: Column) -> Column:
    """A printed day, or the day that an ISO time begins with; null if it is neither."""
    own = F.trim(text)
    # month names are read in any case
    cased = F.initcap(F.lower(own))
    days = [F.try_to_timestamp(cased, F.lit(f)).cast("date") for f in DAY_FORMATS]
    return F.coalesce(*days, F.regexp_extract(own, r"^(\d{4}-\d{2}-\d{2})", 1).try_cast("date"))


def skill_scan(text: Column, terms: Iterable[str]) -> Column:
    """The sorted terms (as written in `terms`) that the text names.

    Terms of up to two characters count in their own case, and not beside
    letters, digits, & - or /; longer ones in any case, not beside letters or
    digits. The longest is taken first and matches do not overlap.
    """
    terms = sorted(set(terms), key=lambda t: (-len(t), t))
    short, long = [t for t in terms if len(t) <= 2], [t for t in terms if len(t) > 2]

    def found(some: list[str], flags: str, block: str) -> Column:
        if not some:
            return F.array().cast("array<string>")
        pattern = f"{flags}(?<![{block}])(?:{'|'.join(chr(92) + 'Q' + t + chr(92) + 'E' for t in some)})(?![{block}])"
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))

    written = F.create_map(*[F.lit(x) for t in long for x in (t.lower(), t)]) if long else None
    hits = F.transform(found(long, "(?iu)", "A-Za-z0-9"), lambda x: F.element_at(written, F.lower(x))) if long else F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(found(short, "", r"A-Za-z0-9&\-/"), hits)))
