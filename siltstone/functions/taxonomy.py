"""Job categories, fields of study, benefits, skills and kinds of employment; all built-in expressions.

A table of (code, pattern) is ordered. Patterns match in any case and any
script. Null and empty texts give null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .postings import first_match, has

# Ordered patterns of job categories.
CATEGORIES = (
    ("data_ai", r"\b(data\s*(?:analyst|scientist|engineer)|machine\s*learning|deep\s*learning|\bai\b|artificial\s*intelligence|nlp|computer\s*vision|business\s*intelligence|\bbi\b)\b"),
    ("swe_backend", r"\b(backend|back-end|python|java|golang|\bgo\b|c\+\+|c\#|\.net|node\.?js|django|fastapi|spring)\s+(?:developer|engineer|dev)\b"),
    ("swe_frontend", r"\b(frontend|front-end|react|vue|angular|javascript|typescript)\s+(?:developer|engineer|dev)\b"),
    ("swe_fullstack", r"\b(full[-\s]?stack|software\s*(?:developer|engineer)|d[eé]veloppeur|desarrollador|programmer)\b"),
    ("design", r"\b(product\s*designer|ui\s*/\s*ux|ux|ui|graphic\s*designer|dise[nñ]ador|graphiste)\b"),
    ("product", r"\b(product\s*manager|product\s*owner|\bpm\b)\b"),
    ("sales", r"\b(sales|account\s*exec|account\s*manager|commercial|ventas|vendeur|business\s*development)\b"),
    ("marketing", r"\b(marketing|seo|growth|content\s*creator|community\s*manager|mercadeo)\b"),
    ("customer_support", r"\b(customer\s*(?:service|support|success)|support\s*technique|soporte\s*t[eé]cnico|helpdesk|call\s*center)\b"),
    ("finance", r"\b(finance|financial|accountant|comptable|contador|auditor|payroll|tr[eé]sorerie)\b"),
    ("hr_people", r"\b(human\s*resources|\bhr\b|recruiter|talent\s*acquisition|recursos\s*humanos|\brh\b)\b"),
    ("legal", r"\b(legal|counsel|lawyer|avocat|juriste|abogado|compliance)\b"),
    ("it_security", r"\b(cybersecurity|infosec|security\s*engineer|s[eé]curit[eé]\s*informatique|seguridad\s*inform[aá]tica)\b"),
    ("operations", r"\b(operations|logistics|supply\s*chain|logistique|operaciones)\b"),
    ("engineering", r"\b(engineer|ing[eé]nieur|ingeniero|engineering)\b"),
)

# How a text names a degree's field, after the degree and after a label (white space in these does not count).
FIELD_AFTER_DEGREE = r"""
    \b(?:
        (?:bachelor(?:['’]s)?|master(?:['’]s)?|ph\.?d\.?|doctorate|doctorat|associate(?:['’]s)?|undergraduate|graduate|university|college)?
        \s*(?:of\s+(?:science|arts|engineering|commerce|business|technology))?
        \s*(?:degree|diploma|licenciatura|t[ií]tulo(?:\s+universitario)?|dipl[oô]me|maestr[ií]a|doctorado|bac\s*\+\s*[345]|bsc|msc|b\.s\.|m\.s\.|b\.a\.|m\.a\.|ph\.?d\.?)
        |
        (?:bachelor(?:['’]s)?|master(?:['’]s)?|ph\.?d\.?|doctorate|doctorat|associate(?:['’]s)?|licenciatura|maestr[ií]a|doctorado|bac\s*\+\s*[345]|\bbs\b|\bms\b|\bba\b|bsc|msc|b\.s\.|m\.s\.|b\.a\.|m\.a\.)
    )
    \s+(?:in|of|en|de|d'|en\s+materia\s+de)\s+
    ([A-Za-z0-9\s,&/\-–À-ſ]+?)
    (?=(?:\s+(?:or|o|ou)\s+(?:a\s+)?(?:closely\s+)?(?:related|relevant|af[ií]n|afines|connexe|equivalent|equivalente|[eé]quivalent|quantitative)(?:\s+(?:field|discipline|area|branche|domaine))?|[.;\n\r]|\z|\s+is\s+required|\s+required\b|\s+preferred\b|\s+with\b|\s+and\s+\d+\+?\s+years))
"""
FIELD_AFTER_LABEL = r"""
    \b(?:degree|major|discipline|field\s+of\s+study|formation|t[ií]tulo)\s*(?:required|needed)?\s*[:\-]\s*
    ([A-Za-z0-9\s,&/\-–À-ſ]+?)
    (?=(?:\s+(?:or|o|ou)\s+(?:a\s+)?(?:related|af[ií]n|connexe|equivalent)\b|[.;\n\r]|\z|\s+is\s+required|\s+required\b|\s+preferred\b))
"""
NO_FIELD = r"\b(nuevo|alert|cookie|apply|click|terms|privacy|equal opportunity|job|position|employment|candidate|experience|years|work|customer|country|client|account|accounts|countries|breakthrough|reality|spoken|written|english|spanish|french)\b"
DEGREE_SENTENCE = r"\b(degree|diploma|dipl[oô]me|licenciatura|bac\s*\+\s*[345]|bachelor|master|ph\.?d\.?|doctorate|doctorat|associate|bsc|msc|b\.s\.|m\.s\.|b\.a\.|m\.a\.)\b"
FIELD_CHARS, FIELD_WORDS, SENTENCE_CHARS = (3, 80), 10, 200

# Patterns of fields of study.
DISCIPLINES = (
    ("computer_science", r"\b(computer\s*sciences?|software(?:\s*engineering)?|informatique|inform[aá]tica|computer\s*engineering|g[eé]nie\s*logiciel|computaci[oó]n|ciencias\s*de\s*la\s*computaci[oó]n|informatik|rechnertechnik|مهندسی\s*کامپیوتر|نرم[\s‌]*افزار|علوم\s*کامپیوتر|\bcs\b)\b"),
    ("information_technology", r"\b(information\s*technolog(?:y|ies)|information\s*systems?|cyber\s*security|cybersecurity|network(?:ing)?|sysadmin|syst[eè]mes\s*d'information|tecnolog[ií]a\s*de\s*la\s*informaci[oó]n|wirtschaftsinformatik|فناوری\s*اطلاعات|\bit\b)\b"),
    ("data_science_statistics", r"\b(data\s*sciences?|data\s*analytics?|statistics?|statistical|statistiques?|estad[ií]sticas?|biostatistics?|business\s*analytics?|ciencia\s*de\s*datos|علم\s*داده|آمار)\b"),
    ("mathematics", r"\b(mathematics?|applied\s*math(?:ematics)?|math[eé]matiques?|matem[aá]ticas?|actuarial(?:\s*science)?|mathematik|ریاضی|\bmath\b)\b"),
    ("engineering_electrical", r"\b(electrical|electronics?|g[eé]nie\s*[eé]lectrique|ingenier[ií]a\s*[eé]l[eé]ctrica|telecom(?:munications?)?|elektrotechnik|مهندسی\s*برق|الکترونیک)\b"),
    ("engineering_mechanical", r"\b(mechanical(?:\s*engineering)?|m[eé]canique|mec[aá]nica|mechatronics?|maschinenbau|مهندسی\s*مکانیک)\b"),
    ("engineering_civil", r"\b(civil(?:\s*engineering)?|construction(?:\s*management)?|g[eé]nie\s*civil|ingenier[ií]a\s*civil|structural(?:\s*engineering)?|bauingenieurwesen|مهندسی\s*عمران)\b"),
    ("engineering_chemical", r"\b(chemical\s*engineering|g[eé]nie\s*chimique|ingenier[ií]a\s*qu[ií]mica|مهندسی\s*شیمی)\b"),
    ("engineering_general", r"\b(engineering|ing[eé]nierie|ingenier[ií]a|industrial\s*engineering|wirtschaftsingenieurwesen|مهندسی\s*صنایع)\b"),
    ("business_administration", r"\b(business\s*administration|business\s*management|gesti[oó]n|administraci[oó]n(?:\s*de\s*empresas)?|management|commerce|betriebswirtschaft|\bbwl\b|مدیریت|مدیریت\s*بازرگانی|مدیریت\s*کسب\s*و\s*کار|\bmba\b)\b"),
    ("finance_accounting", r"\b(finance|financial|accounting|accountancy|economics?|comptabilit[eé]|finanzas|contabilidad|econom[ií]a|audit|banking|finanzwesen|rechnungswesen|حسابداری|مدیریت\s*مالی|اقتصاد)\b"),
    ("marketing_communications", r"\b(marketing|communications?|advertising|journalism|public\s*relations?|relaciones\s*p[uú]blicas|media(?:\s*studies)?|بازاریابی|مارکتینگ)\b"),
    ("human_resources", r"\b(human\s*resources?|ressources\s*humaines|recursos\s*humanos|\bhr\b|talent\s*management|منابع\s*انسانی)\b"),
    ("healthcare_nursing", r"\b(nursing|medicine|pharmacy|public\s*health|sant[eé]|enfermer[ií]a|medicina|pharmacology|healthcare|krankenpflege|پزشکی|پرستاری|داروسازی)\b"),
    ("natural_sciences", r"\b(physics|chemistry|biology|biotechnology|biotech|biochemistry|physique|chimie|biologie|f[ií]sica|qu[ií]mica|environmental\s*science|شیمی|زیست[\s‌]*شناسی)\b"),
    ("social_sciences", r"\b(psychology|sociology|political\s*science|international\s*relations?|psychologie|sociologie|psicolog[ií]a|ciencias\s*sociales|روانشناسی|علوم\s*اجتماعی)\b"),
    ("law_legal", r"\b(law|legal(?:\s*studies)?|droit|derecho|jurisprudence|jura|rechtswissenschaften|حقوق|\bllb\b|\bllm\b|\bjd\b)\b"),
    ("education_teaching", r"\b(education|[eé]ducation|teaching|pedagogy|enseignement|pedagog[ií]a|آموزش)\b"),
    ("arts_design", r"\b(design|architecture|fine\s*arts?|graphic(?:\s*design)?|visual\s*arts?|dise[nñ]o|طراحی|معماری)\b"),
    ("agriculture", r"\b(agriculture|agronomy|forestry|veterinary|agronome|agronom[ií]a|کشاورزی)\b"),
    ("logistics_supply_chain", r"\b(supply\s*chain|logistics?|procurement|log[ií]stica|approvisionnement|لجستیک|زنجیره\s*تامین)\b"),
    ("stem_general", r"\b(stem|quantitative(?:\s*field)?|scientific\s*discipline|technical\s*field)\b"),
)

# Patterns of benefits.
BENEFITS = (
    ("health_insurance", r"\b(?:(?:health|medical)\s+(?:insurance|coverage|care|plan|benefits?)|seguro\s+m[eé]dico|seguro\s+de\s+salud|seguro\s+privado|seguro\s+de\s+vida|krankenversicherung|mutuelle(?:\s+sant[eé])?|بیمه(?:\s+تامین\s+اجتماعی|\s+تکمیلی)?)\b"),
    ("dental_vision", r"\b(?:(?:dental|vision)\s+(?:insurance|coverage|plan|benefits?)|seguro\s+dental|zahnzusatzversicherung)\b"),
    ("retirement_401k", r"\b(?:401\(?k\)?|pension|retirement\s*(?:plan|fund|benefits?)|superannuation|plan\s+de\s+pensiones|fondo\s+de\s+jubilaci[oó]n|betriebliche\s+altersvorsorge)\b"),
    ("paid_time_off", r"\b(?:paid\s+time\s+off|pto|vacation\s+days|annual\s+leave|vacaciones\s+pagadas|d[ií]as\s+de\s+vacaciones|urlaubstage|cong[eé]s\s+pay[eé]s|مرخصی)\b"),
    ("equity_stock_options", r"\b(?:equity|stock\s+options|esop|rsu|company\s+shares|opciones\s+sobre\s+acciones|aktienoptionen)\b"),
    ("parental_leave", r"\b(?:(?:parental|maternity|paternity)\s+leave|baja\s+por\s+maternidad|elternzeit|cong[eé]\s+maternit[eé])\b"),
    ("tuition_reimbursement", r"\b(?:tuition\s+(?:reimbursement|assistance)|education\s+stipend|learning\s+budget|formaci[oó]n\s+continua|weiterbildung|آموزش|بودجه\s*آموزشی)\b"),
    ("relocation_assistance", r"\b(?:relocation\s+(?:assistance|package|support|allowance)|ayuda\s+de\s+relocalizaci[oó]n|umzugshilfe)\b"),
    ("wellness_perks", r"\b(?:gym\s+membership|wellness\s+stipend|mental\s+health\s+support|gimnasio|fitnessstudio|صبحانه|ناهار|سرویس\s+رفت\s+و\s+برگشت)\b"),
)

# Patterns of skills.
SKILLS = (
    ("python", r"\bpython\b"),
    ("sql", r"\bsql\b"),
    ("javascript", r"\b(?:javascript|js)\b"),
    ("typescript", r"\b(?:typescript|ts)\b"),
    ("java", r"\bjava\b(?!\s*script)"),
    ("c_cpp", r"\b(?:c\+\+|cpp)\b"),
    ("c_sharp", r"\b(?:c#|csharp)\b"),
    ("go_golang", r"\b(?:golang|go\s+programming)\b"),
    ("rust", r"\brust\b(?!\s*(?:stain|iron))"),
    ("ruby", r"\bruby(?:\s+on\s+rails)?\b"),
    ("php", r"\bphp\b"),
    ("swift", r"\bswift\b(?!\s*code)"),
    ("kotlin", r"\bkotlin\b"),
    ("r_lang", r"\b(?:r\s+programming|r\s+language)\b"),
    ("scala", r"\bscala\b"),
    ("react", r"\breact(?:\.js|js)?\b"),
    ("angular", r"\bangular(?:\.js|js)?\b"),
    ("vue", r"\bvue(?:\.js|js)?\b"),
    ("node_js", r"\bnode(?:\.js|js)?\b"),
    ("django", r"\bdjango\b"),
    ("fastapi", r"\bfastapi\b"),
    ("flask", r"\bflask\b"),
    ("spring_boot", r"\bspring\s*boot\b"),
    ("dotnet", r"\b(?:\.net|dotnet)\b"),
    ("aws", r"\baws\b|\bamazon\s+web\s+services\b"),
    ("azure", r"\b(?:azure|microsoft\s+azure)\b"),
    ("gcp", r"\b(?:gcp|google\s+cloud)\b"),
    ("docker", r"\bdocker\b"),
    ("kubernetes", r"\b(?:kubernetes|k8s)\b"),
    ("terraform", r"\bterraform\b"),
    ("linux", r"\blinux\b"),
    ("git", r"\bgit\b|\bgithub\b|\bgitlab\b"),
    ("ci_cd", r"\bci[/-]?cd\b"),
    ("postgresql", r"\b(?:postgres|postgresql)\b"),
    ("mysql", r"\bmysql\b"),
    ("mongodb", r"\bmongodb\b"),
    ("redis", r"\bredis\b"),
    ("elasticsearch", r"\belasticsearch\b"),
    ("snowflake", r"\bsnowflake\b"),
    ("bigquery", r"\bbigquery\b"),
    ("pandas", r"\bpandas\b"),
    ("numpy", r"\bnumpy\b"),
    ("pytorch", r"\bpytorch\b"),
    ("tensorflow", r"\btensorflow\b"),
    ("scikit_learn", r"\bscikit[-_]?learn\b"),
    ("spark", r"\b(?:apache\s+spark|pyspark|spark)\b"),
    ("tableau", r"\btableau\b"),
    ("power_bi", r"\bpower\s*bi\b"),
    ("excel", r"\b(?:microsoft\s+excel|advanced\s+excel)\b"),
    ("machine_learning", r"\bmachine\s+learning\b|\bml\b"),
    ("deep_learning", r"\bdeep\s+learning\b"),
    ("nlp", r"\bnatural\s+language\s+processing\b|\bnlp\b"),
    ("computer_vision", r"\bcomputer\s+vision\b"),
    ("agile_scrum", r"\b(?:agile|scrum)\b"),
    ("project_management", r"\bproject\s+management\b"),
    ("salesforce", r"\bsalesforce\b"),
    ("jira", r"\bjira\b"),
)

# Kinds of employment by the words, and by the numbered contracts and days, that sources use.
EMPLOYMENT_WORDS = (("full_time", "full_time"), ("part_time", "part_time"), ("intern", "internship"), ("temporary", "temporary"), ("contractor", "contract"), ("freelance", "freelance"))
CONTRACT_WORDS = ("contract", "temporary")
CONTRACT_NUMBERS = (("4", "freelance"), ("5", "internship"), ("6", "apprenticeship"))
PART_DAY, FULL_DAY = "2", "1"
CONTRACT_KINDS = (("3", "temporary"), ("1", "contract"), ("2", "full_time"))


def tags(text: Column, table: Iterable[tuple[str, str]]) -> Column:
    """The codes whose pattern the text holds, in the table's order, joined by commas; null if there is none."""
    return F.nullif(F.concat_ws(",", *[F.when(has(text, pattern), code) for code, pattern in table]), F.lit(""))


def job_category(title: Column, raw: Column) -> Column:
    """By the source's own category, else by the title."""
    return F.coalesce(first_match(raw, CATEGORIES), first_match(title, CATEGORIES))


def field_of_study(text: Column) -> Column:
    """The first phrase that a text gives as a degree's field: after a degree's name first, after a label else."""

    def phrases(pattern: str) -> Column:
        found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?iux)" + pattern), F.lit(1))
        return F.transform(found, lambda x: F.regexp_replace(x, r"^[ \t\r\n,.;:\-]+|[ \t\r\n,.;:\-]+$", ""))

    def fine(x: Column) -> Column:
        return F.length(x).between(*FIELD_CHARS) & (F.size(F.split(x, r"(?U)\s+")) <= FIELD_WORDS) & ~x.rlike("(?iU)" + NO_FIELD)

    return F.try_element_at(F.filter(F.concat(phrases(FIELD_AFTER_DEGREE), phrases(FIELD_AFTER_LABEL)), fine), F.lit(1))


def discipline(text: Column) -> Column:
    return tags(text, DISCIPLINES)


def education(text: Column) -> tuple[Column, Column]:
    """The named field of study, and its disciplines; where it has none, those of the short sentences that name a degree."""
    raw = field_of_study(text)
    sentences = F.transform(F.split(F.coalesce(text, F.lit("")), r"[.\n\r;]"), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", ""))
    scoped = F.filter(sentences, lambda s: s.rlike("(?iU)" + DEGREE_SENTENCE) & (F.length(s) <= SENTENCE_CHARS))
    return raw, F.coalesce(discipline(raw), discipline(F.concat_ws(" ", scoped)))


def employment_by_word(raw: Column) -> Column:
    """An employmentType word, its case, dashes and spaces aside."""
    own = F.translate(F.lower(F.trim(raw)), "- ", "__")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in EMPLOYMENT_WORDS for x in pair]), own)


def employment_by_flags(contract: Column, full_time: Column, part_time: Column) -> Column:
    """A contract that says what it is goes before the flags; full time before part time."""
    own = F.lower(F.trim(contract))
    return F.when(own.isin(*CONTRACT_WORDS), own).when(full_time, "full_time").when(part_time, "part_time")


def employment_by_number(contract: Column, day: Column) -> Column:
    """By the numbers of the contract and of the day's length."""
    c, d = F.trim(F.coalesce(contract, F.lit(""))), F.trim(F.coalesce(day, F.lit("")))
    out = F.when(F.lit(False), "")
    for number, code in CONTRACT_NUMBERS:
        out = out.when(c == number, code)
    out = out.when(d == PART_DAY, "part_time")
    for number, code in CONTRACT_KINDS:
        out = out.when(c == number, code)
    return out.when(d == FULL_DAY, "full_time")
