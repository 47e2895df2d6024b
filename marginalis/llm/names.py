"""Variant spellings of people and organisations, linked by merge and rematch
(problem 6).

A name is read into a profile: forms (given name, surname), middle initials,
word lists of organisations, and what it only hints at (initials, handles,
acronyms, shortened forms).  Profiles that share a sure key merge; a merged
profile holds all spellings and initials of its members and re-enters blocking,
where hints look for the one profile that offers what they hint at.  This goes
on until nothing merges.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalis.session import cut

# Names that identify nobody.
STAND_INS = ("user", "reviewer", "author", "admin", "unknown", "anonymous")

# Titles before a name.
TITLES = ("mr", "mrs", "ms", "miss", "mx", "dr", "prof", "professor", "sir", "dame", "eng", "rev", "hon", "m", "mme", "mlle", "sr", "sra")

# Particles that belong to the surname after them.
PARTICLES = ("de", "del", "della", "di", "da", "dos", "du", "la", "le", "van", "von", "der", "den", "ter", "el", "al", "bin", "ibn", "abu", "ben", "st", "san", "mac", "o")

# Words of organisations, with their abbreviations.
ORGANISATION_WORDS = {
    "associates": ("assoc", "assocs", "assc"),
    "association": (),
    "agency": ("agcy",),
    "board": ("bd",),
    "books": ("bks",),
    "centre": ("center", "ctr"),
    "college": ("coll",),
    "committee": ("cttee", "comm"),
    "company": ("co", "cpny"),
    "consulting": ("cons",),
    "corporation": ("corp",),
    "council": ("cncl",),
    "curriculum": ("curr", "curric", "currclm"),
    "department": ("dept", "dpt", "dep"),
    "design": ("des",),
    "division": ("div",),
    "editorial": ("edit", "edtl", "editl", "ed"),
    "education": ("educ", "edu"),
    "educational": ("educl",),
    "foundation": ("fdn",),
    "group": ("grp", "gp"),
    "house": ("hse",),
    "institute": ("inst",),
    "international": ("intl", "int"),
    "language": ("lang", "lng"),
    "learning": ("learn", "learng", "lrng", "lrn"),
    "library": ("lib",),
    "office": ("off", "ofc"),
    "partners": ("ptnrs", "ptrs", "prtnrs", "part", "partn"),
    "press": ("prs",),
    "production": ("prod",),
    "proofing": ("proof", "prfg", "proofg"),
    "publishers": ("publs", "pubs"),
    "publishing": ("publ", "pub", "pubg"),
    "research": ("res", "rsch"),
    "review": ("rev", "rvw"),
    "school": ("sch",),
    "services": ("serv", "servs", "svcs", "svc", "srvs"),
    "society": ("soc",),
    "solutions": ("sol", "solns"),
    "studio": ("std",),
    "team": ("tm",),
    "textbook": ("text", "textb", "txtbk", "textbk", "tbk"),
    "translation": ("transl", "trans"),
    "university": ("univ", "uni"),
    "works": ("wks",),
}

# Legal forms and articles that don't tell organisations apart.
ORGANISATION_FILLERS = ("the", "ltd", "limited", "inc", "llc", "llp", "plc", "gmbh", "sa", "sarl", "and")

# Given names and the other spellings and short forms of each; a short form may belong to several.
GIVEN_NAMES = {
    "abdullah": ("abdallah", "abdulla"),
    "ahmad": ("ahmed", "ahmet"),
    "alexander": ("alex", "sasha", "aleksandr", "alexandre", "alejandro", "sandy", "xander", "alec", "aleksander"),
    "alexandra": ("alex", "sasha", "sandra", "sandy", "aleksandra"),
    "ali": ("aly",),
    "amina": ("aminah", "ameena"),
    "andrew": ("andy", "drew", "andrei", "andrey", "andre", "andres"),
    "anna": ("ana", "anne", "ann", "anya", "annie"),
    "anthony": ("tony", "antony", "toni"),
    "antonio": ("toni", "tony", "anton", "antoine", "tonio"),
    "barbara": ("barb", "babs"),
    "benjamin": ("ben", "benny", "benji", "benjy"),
    "carlos": ("charles", "carl", "karl"),
    "catherine": ("cathy", "cate", "kate", "kathy", "kitty"),
    "charles": ("charlie", "chuck", "chas"),
    "charlotte": ("lottie", "charlie", "lotte", "lotta", "char"),
    "christina": ("chris", "tina", "christine", "kristina"),
    "christopher": ("chris", "kit", "topher", "kristopher", "christoph", "cristopher"),
    "daniel": ("dan", "danny", "daniil"),
    "david": ("dave", "davy"),
    "deborah": ("deb", "debbie", "debra"),
    "dmitri": ("dima", "dmitry", "dimitri", "dmitriy", "mitya"),
    "dorothy": ("dot", "dottie", "dolly"),
    "edward": ("ed", "eddie", "ted", "ned", "teddy"),
    "ekaterina": ("katya", "katia", "yekaterina", "jekaterina", "katja"),
    "eleanor": ("ellie", "nell", "nora"),
    "elizabeth": ("liz", "beth", "lizzie", "eliza", "betty", "libby", "betsy", "elisabeth", "lisa", "bess"),
    "emily": ("em", "emmy", "emilie"),
    "fatima": ("fatma", "fatimah", "fatema", "fatimeh", "fatme"),
    "francis": ("frank", "fran", "francesco", "francisco"),
    "francois": ("frank", "fran", "francoise", "franz"),
    "frederick": ("fred", "freddie", "fredrick"),
    "gabriel": ("gabe", "gabi", "gaby", "jibril"),
    "gabriela": ("gabi", "gaby", "gabriella", "gabrielle"),
    "george": ("georgie", "georges", "georg", "jorge"),
    "gregory": ("greg", "grigori", "grigory"),
    "hassan": ("hasan",),
    "helen": ("helena", "nell", "lena", "elena", "helene"),
    "henry": ("harry", "hank", "henri"),
    "hussein": ("hussain", "hosein", "husain", "husayn", "hossein", "husein", "hussien", "huseyin"),
    "ibrahim": ("ebrahim", "ibraheem", "abraham", "ibrahem", "ibo", "brahim"),
    "irina": ("ira", "irene"),
    "isabella": ("bella", "izzy", "isa", "isabelle", "isabel", "bell"),
    "ivan": ("vanya",),
    "james": ("jim", "jimmy", "jamie"),
    "jennifer": ("jen", "jenny", "jenn", "jenifer"),
    "jessica": ("jess", "jessie"),
    "john": ("jack", "johnny", "jon", "jean", "juan"),
    "jonathan": ("jon", "jonny", "nathan"),
    "joseph": ("joe", "joey", "jose", "yusuf"),
    "josephine": ("josie", "jo", "fifi", "josefine", "jozephine"),
    "joshua": ("josh",),
    "katherine": ("kate", "kathy", "katie", "kat", "kathryn", "katharine", "kay", "kitty", "katy", "catherine", "kathi"),
    "khalid": ("khaled", "halid", "kaled", "chalid", "khaleed"),
    "laura": ("laurie", "lori"),
    "lawrence": ("larry", "laurence", "lars"),
    "leila": ("layla", "leyla", "laila", "layli", "leilah", "laylah", "lila"),
    "leonard": ("leo", "len", "lenny"),
    "louis": ("lou", "luis", "lewis"),
    "lucas": ("luke", "luca"),
    "mahmoud": ("mahmud", "mahmood"),
    "margaret": ("maggie", "peg", "meg", "peggy", "margie", "marge", "greta", "daisy", "margret", "margarita"),
    "maria": ("marie", "mary", "masha", "mariya"),
    "mariam": ("maryam", "miriam", "myriam", "maryem"),
    "martin": ("marty", "martyn"),
    "matthew": ("matt", "mat", "mathew", "matthieu"),
    "michael": ("mike", "mick", "mickey", "misha", "mikhail", "michel", "miguel", "micheal"),
    "mohammad": ("muhammad", "mohamed", "mohammed", "mhd", "mohamad", "muhammed", "md", "moh", "mohd", "muhamad", "mehmet"),
    "mustafa": ("mostafa", "moustafa", "mustapha"),
    "nadine": ("nadin", "nadeen", "nadia", "nadya", "nadyne", "nad", "dina"),
    "natalia": ("natasha", "natalie", "nataliya", "nat"),
    "nicholas": ("nick", "nicky", "nico", "nicolas", "nikolas", "klaus"),
    "nicolas": ("nico", "nick", "nicholas", "nicolo", "nikolas", "nicky"),
    "nikolai": ("kolya", "nick", "nikolay"),
    "olga": ("olya",),
    "omar": ("umar", "omer"),
    "pamela": ("pam",),
    "patricia": ("pat", "patty", "tricia", "trish", "pattie"),
    "patrick": ("pat", "paddy", "rick", "patric", "patrik"),
    "paul": ("pablo", "pavel", "paolo"),
    "peter": ("pete", "pyotr", "pedro", "pierre", "piotr"),
    "philip": ("phil", "phillip", "philippe", "pip"),
    "rachel": ("rach", "rachael"),
    "rebecca": ("becky", "becca", "beck", "rebekah", "reba", "bec"),
    "richard": ("rick", "dick", "rich", "ricky", "ricardo"),
    "robert": ("rob", "bob", "bobby", "bert", "robbie", "roberto", "robin"),
    "salim": ("saleem", "selim"),
    "samantha": ("sam", "sammy"),
    "samira": ("sam", "sami", "sameera", "mira", "samirah"),
    "samuel": ("sam", "sammy"),
    "sarah": ("sara", "sally"),
    "sergei": ("sergey", "serge", "seryozha", "sergio"),
    "sophia": ("sophie", "sofia", "sonia", "sonya", "sofya"),
    "stephen": ("steve", "steven", "stefan", "stephan"),
    "susan": ("sue", "susie", "suzanne", "suzy"),
    "svetlana": ("sveta", "lana"),
    "tatiana": ("tanya", "tatyana", "tania"),
    "theodore": ("ted", "theo", "teddy", "teodor", "theodor"),
    "thomas": ("tom", "tommy", "tomas"),
    "timothy": ("tim", "timmy"),
    "victoria": ("vicky", "vicki", "tori", "vic", "vickie", "viktoria"),
    "vincent": ("vince", "vinny"),
    "vladimir": ("volodya", "vlad", "vova"),
    "walter": ("walt", "wally"),
    "william": ("bill", "will", "billy", "liam", "willy", "wm", "guillaume"),
    "yasmin": ("yasmine", "jasmine", "yasmeen"),
    "youssef": ("yousef", "yusuf", "yusef", "joseph", "youssif", "yousif", "josef", "yosef", "jousef", "joe"),
    "zachary": ("zach", "zack", "zac"),
    "zeinab": ("zaynab", "zainab", "zeina", "zeynep", "zaineb", "zenab", "zineb"),
}

#: Letters without a decomposition, and what they are typed as.
PLAIN = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "ð": "d", "þ": "th", "’": "'", "‘": "'"})


@cache
def given_classes() -> dict[str, frozenset[str]]:
    """Spelling of a given name to the names it may stand for."""
    made: dict[str, set[str]] = {}
    for name, others in GIVEN_NAMES.items():
        for spelling in (name, *others):
            made.setdefault(spelling, set()).add(name)
    # a name of its own stands for itself, whatever else it is short for
    return {s: frozenset({s}) if s in GIVEN_NAMES else frozenset(c) for s, c in made.items()}


@cache
def organisation_words() -> dict[str, str]:
    return {a: w for w, others in ORGANISATION_WORDS.items() for a in (w, *others)}


def fold(text: str) -> str:
    """Lower case without accents."""
    low = unicodedata.normalize("NFKD", text.casefold().translate(PLAIN))
    return "".join(c for c in low if not unicodedata.combining(c))


def words(name: str) -> tuple[list[str], bool]:
    """(words in reading order, whether a comma turned them round); words keep
    their case, initials are single letters."""
    text = re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", unicodedata.normalize("NFKC", name))
    text = re.sub(r"(?<=[^\W\d_])@.*$", "", text.strip())
    text = text.replace("_", " ")
    turned = False
    if text.count(",") == 1:
        last, first = text.split(",")
        if last.strip() and first.strip() and fold(first).strip(" .") not in (*ORGANISATION_FILLERS, "jr", "phd", "md"):
            text, turned = f"{first} {last}", True
    text = re.sub(r"(?<=[^\W\d_A-Z])(?=[A-ZÀ-ÖØ-Þ])", " ", text) if " " not in text.strip() else text
    text = re.sub(r"['’]", "", text)
    return re.findall(r"[^\W_]+(?:-+[^\W_]+)*", text.replace(",", " ")), turned


def read_name(name: str) -> dict | None:
    """Profile of one spelling: kind, sure forms and hints; None for stand-ins.

    forms are strings 'given|surname' (people) or space-joined words
    (organisations); hints are keys another profile may offer; plain holds the
    words of a name of two and more, without initials, in reading order.
    """
    profile = _profile(name)
    if profile is not None:
        spelled = [p for w in words(name)[0] for p in fold(w).split("-") if p and p not in ORGANISATION_FILLERS]
        spelled = spelled[1:] if len(spelled) > 2 and spelled[0] in TITLES else spelled
        spelled = [organisation_words().get(w, w) if i else w for i, w in enumerate(spelled)]
        profile["plain"] = " ".join(spelled) if 2 <= len(spelled) <= ABBREVIATED and min(map(len, spelled)) > 1 else ""
    return profile


def _profile(name: str) -> dict | None:
    plain = fold(name.strip())
    if not plain or plain in STAND_INS or not re.search(r"[^\W\d_]", plain):
        return None
    raw, turned = words(name)
    flat = [p for w in raw for p in fold(w).split("-") if p]
    known = organisation_words()
    spelled = [w for w in flat if w not in ORGANISATION_FILLERS]
    dotted = re.fullmatch(r"\s*(?:[^\W\d_]\.\s*){2,}\s*", name)
    if dotted or (len(raw) == 1 and re.fullmatch(r"[A-Z]{2,5}", raw[0])):
        return {"kind": "hint", "forms": [], "middle": [], "hints": ["acr " + "".join(flat)]}
    full_word = [w for w in spelled if w in ORGANISATION_WORDS]
    # a word of an organisation in full, or a dotted abbreviation that ends the name
    if len(spelled) >= 2 and (full_word or (not any(len(w) == 1 for w in spelled) and spelled[-1] in known and spelled[-1] not in given_classes() and spelled[0] not in given_classes())):
        full = [known.get(w, w) if i else w for i, w in enumerate(spelled)]
        return {"kind": "org", "forms": [" ".join(full)], "middle": [], "hints": []}
    parts = [fold(w).replace("-", "") for w in raw]
    if len(parts) > 1 and parts[0] in TITLES and len(parts[0]) > 1:
        parts = parts[1:]
    classes = given_classes()
    joined: list[str] = []
    carry = ""
    for p in parts:
        lead_in = p in PARTICLES and len(p) > 1 and (joined or carry or (len(parts) > 2 and p not in classes))
        if lead_in and p is not parts[-1]:
            carry += p
        else:
            joined.append(carry + p)
            carry = ""
    initials = [p for p in joined if len(p) == 1]
    long = [p for p in joined if len(p) > 1]
    lead = len(joined) > 0 and len(joined[0]) == 1
    if not long:
        return {"kind": "hint", "forms": [], "middle": [], "hints": ["acr " + "".join(initials)]}
    if len(long) == 1:
        if initials:
            # A. Orton, Orton A., A.B. Wynné
            return {"kind": "hint", "forms": [], "middle": initials[1:2], "hints": [f"ini {initials[0]} {long[0]}"]}
        return {"kind": "hint", "forms": [], "middle": [], "hints": [f"run {long[0]}"]}
    middle = [] if lead else initials[:1]
    pairs = [(long[0], "".join(long[1:]))]
    if len(long) == 2:
        pairs.append((long[1], long[0]))
    else:
        pairs += [(long[-1], "".join(long[:-1]))]
    known_given = [p for p in pairs if p[0] in classes]
    if turned:
        pairs = pairs[:1]
    elif known_given:
        pairs = known_given[:1]
    forms, hints = [], []
    for given, surname in pairs:
        meant = classes.get(given, frozenset({given}))
        if len(meant) == 1:
            forms.append(f"{next(iter(meant))}|{surname}")
        else:
            hints += [f"nick {m}|{surname}" for m in sorted(meant)]
    return {"kind": "person" if forms else "hint", "forms": forms, "middle": middle, "hints": sorted(hints)}


def sure_key(profile: dict) -> str:
    """Equal for spellings that are the same name beyond doubt: the words in
    any order, whichever is the given name; for hints, the hint."""
    if profile["kind"] == "person":
        return "p " + min("|".join(sorted(f.split("|"))) for f in profile["forms"])
    return ("o " + profile["forms"][0]) if profile["kind"] == "org" else "h " + ";".join(profile["hints"] + profile["middle"])


#: Longer texts are compared by halves, as their deletions would take up the square of their length.
LONG = 64


def edit_keys(text: str) -> set[str]:
    """Keys of which two texts one edit apart share one.

    Short texts: the text, and it less one letter.  Long ones: the beginning
    and the end at the middle and one letter around it; an edit leaves one of
    them as it is.  Texts about as long as the limit have both.
    """
    keys = {text, *(text[:i] + text[i + 1 :] for i in range(len(text)))} if len(text) <= LONG + 1 else set()
    if len(text) >= LONG:
        middle = len(text) // 2
        keys |= {f"<{text[:h]}" for h in (middle - 1, middle, middle + 1)} | {f">{text[h:]}" for h in (middle - 1, middle, middle + 1)}
    return keys


#: Names of more words aren't taken for the full form or an abbreviation of another.
ABBREVIATED = 16


def abbreviation_pattern(plain: str) -> str:
    """Pattern of the names that a name may abbreviate: each word the same, or
    two and more letters longer, with the same first letter and the others in
    order.  Words of the list have their meaning and stand as they are."""
    made = []
    for w in plain.split(" "):
        longer = w[0] + "".join(f"[^{c} ]*{c}" for c in w[1:]) + "[^ ]*"
        made.append(w if w in ORGANISATION_WORDS else f"(?:{w}|(?=[^ ]{{{len(w) + 2},}}){longer})")
    return "^" + " ".join(made) + "$"


def abbreviation_rows(plain: str, is_org: bool) -> Iterator[tuple[str, str, str, str]]:
    """(role, kind, key, text) by which names that are in no list meet:

    abbr: names of three and more words that abbreviate each other word by
    word, by their initials and one word they share, if possible one that isn't
    common among organisations; pre: a first word cut short, all others the
    same; acr2: initials of a name that isn't known to be an organisation.
    """
    parts = plain.split(" ")
    listed, common = given_classes(), organisation_words()
    first, rest = parts[0], " ".join(parts[1:])
    if not is_org and first not in listed:
        for n in range(3, len(first) - 1):
            yield "o", "pre", f"{first[:n]}|{rest}", ""
        if len(first) > 2:
            yield "s", "pre", f"{first}|{rest}", ""
    if len(parts) > 2:
        initials = "".join(w[0] for w in parts)
        if not is_org:
            yield "o", "acr2", initials, ""
        telling = [i for i, w in enumerate(parts) if w not in common] or range(len(parts))
        for i in telling:
            yield "o", "abbr", f"{initials} {i} {parts[i]}", plain
            yield "s", "abbr", f"{initials} {i} {parts[i]}", abbreviation_pattern(plain)


#: A profile of more spellings than MISTYPED is mistyped only if another has at
#: least so many times its spellings and its rows; else it is a name of its own.
MISTYPED, TIMES_SPELLINGS, TIMES_ROWS = 2, 2, 20


def blocking_rows(cid: str, forms: list[str], middle: list[str], hints: list[str], plains: list[str], spellings: int, count: int) -> Iterator[tuple]:
    """(cid, role, kind, key, text, spellings, count): what a profile offers
    (role o) and seeks (role s, or h for a hint with a typing error)."""
    row = lambda role, kind, key, text="": (cid, role, kind, key, text, spellings, count)
    offered, sought = set(), set()
    known = "".join(sorted(set(middle)))
    for f in forms:
        for key in edit_keys(f):
            offered.add(row("o", "typo", key, f))
        if "|" in f:
            given, surname = f.split("|")
            offered.add(row("o", "ini", f"{given[0]} {surname}", known))
            offered.add(row("o", "nick", f))
            for run in (given[0] + surname, surname + given[0], given + surname, surname + given):
                offered.add(row("o", "run", run))
        else:
            parts = f.split(" ")
            offered.add(row("o", "run", "".join(parts)))
            if len(parts) > 2:
                offered.add(row("o", "acr", "".join(w[0] for w in parts)))
                offered.add(row("o", "short", " ".join(parts[:-1])))
            sought.add(row("s", "short", f))
        for key in edit_keys(f):
            sought.add(row("s", "typo", key, f))
    if not forms:
        for h in hints:
            kind, key = h.split(" ", 1)
            sought.add(row("s", kind, key, known))
            if kind == "acr":
                sought.add(row("s", "acr2", key))
            if kind == "nick":
                for part in edit_keys(key):
                    sought.add(row("h", "typo", part, key))
    is_org = any("|" not in f for f in forms)
    for plain in plains:
        for role, kind, key, text in abbreviation_rows(plain, is_org):
            (offered if role == "o" else sought).add(row(role, kind, key, text))
    yield from offered
    yield from sought


_BLOCKS = "cid string, role string, kind string, key string, text string, spellings long, count long"
_PROFILE = "name string, sure string, forms array<string>, middle array<string>, hints array<string>, plain string, count long"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for name, count in zip(batch["name"], batch["count"], strict=True):
            p = read_name(name) if isinstance(name, str) else None
            if p is not None:
                out.append((name, sure_key(p), p["forms"], p["middle"], p["hints"], p["plain"], count))
        yield pd.DataFrame(out, columns=["name", "sure", "forms", "middle", "hints", "plain", "count"])


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [r for p in batch.itertuples(index=False) for r in blocking_rows(p.cid, list(p.forms), list(p.middle), list(p.hints), list(p.plains), p.spellings, p.count)]
        yield pd.DataFrame(rows, columns=["cid", "role", "kind", "key", "text", "spellings", "count"])


def distinct_names(columns: list[DataFrame]) -> DataFrame:
    """(name, count) of one-column tables; counted per table before they meet."""
    parts = [c.toDF("name").where("name is not null").groupBy("name").agg(F.count("*").alias("n")) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("name").agg(F.sum("n").alias("count"))


def link_names(names: DataFrame) -> DataFrame:
    """(name, entity): every name that stands for somebody, and its entity.

    ``names`` has distinct names and their row counts.  Null, blank and
    stand-in names are left out; an entity's id is the smallest of its sure
    keys' names.  Names that differ only in case, blanks, word order, accents,
    titles, remarks in brackets, or in known short forms and transliterations
    are one.  Initials, handles, acronyms, shortened organisations and short
    forms of several names join the one entity that offers what they say; with
    two or more such entities they stay alone.  Where that says nothing, names
    in no list are compared by rule: three and more words that abbreviate
    another name word by word, a first word cut short by two and more letters,
    initials; each joins the one entity that fits.  A spelling with one typing
    error joins the one better attested entity within one edit; if it itself
    occurs in more than MISTYPED ways, only one that is attested many times as
    well, or else it is a name of its own.  Names of
    any length are read whole.  An empty table gives an empty one.

    Plan: everything is keyed by what profiles offer and seek.  Offers of a
    key are reduced to their number, least and largest profile before they
    meet who seeks it, so a popular key makes no product; only typing errors
    and abbreviations, whose keys few profiles share, are compared one by one.
    A seeker merges only with a profile that doesn't itself merge in the round,
    which makes every merge one hop; chains take further rounds, and of two
    that seek each other the larger id merges.
    """
    read = cut(names.mapInPandas(_read, _PROFILE))
    ids = read.groupBy("sure").agg(F.min("name").alias("entity"))
    members = cut(read.join(ids, "sure").select("name", "entity", "forms", "middle", "hints", "plain", "count"))
    while True:
        profiles = members.groupBy(F.col("entity").alias("cid")).agg(
            F.array_distinct(F.flatten(F.collect_set("forms"))).alias("forms"),
            F.array_distinct(F.flatten(F.collect_set("middle"))).alias("middle"),
            F.array_distinct(F.flatten(F.collect_set("hints"))).alias("hints"),
            F.collect_set(F.nullif(F.col("plain"), F.lit(""))).alias("plains"),
            F.count("*").alias("spellings"),
            F.sum("count").alias("count"),
        )
        # written, as both are read several times, and files tell Spark their size when it chooses the joins
        blocks = cut(profiles.mapInPandas(_blocks, _BLOCKS))
        found = cut(_sought(blocks))
        # further tiers are looked at once nothing else merges: until then a name may have more spellings than it seems
        tier = found.agg(F.min("tier")).first()[0]
        if tier is None:
            return members.select("name", "entity")
        settled = _one_hop(found.where(F.col("tier") == tier).select("cid_a", "cid_b"))
        members = cut(
            members.join(settled.withColumnRenamed("cid_a", "entity"), "entity", "left").select(
                "name", F.coalesce("cid_b", "entity").alias("entity"), "forms", "middle", "hints", "plain", "count"
            )
        )


#: Kinds of keys in the order in which they are believed; two profiles that offer the same are told apart by none.
TIERS = {"ini": 0, "nick": 0, "run": 0, "acr": 0, "short": 0, "abbr": 1, "pre": 1, "acr2": 1, "typo": 2}
PAIRWISE = ("abbr", "typo")


def _sought(blocks: DataFrame) -> DataFrame:
    """(cid_a, cid_b, tier): the one profile that fits a seeker on the first
    tier where any does."""
    side = lambda roles, s: blocks.where(F.col("role").isin(*roles)).select("kind", "key", *[F.col(c).alias(c + s) for c in ("role", "cid", "text", "spellings", "count")])
    a, b = side("sh", "_a"), side("o", "_b")
    pairwise = F.col("kind").isin(*PAIRWISE)
    me, lo, hi, n = (F.col(c) for c in ("cid_a", "lo", "hi", "n"))
    offers = b.where(~pairwise).groupBy("kind", "key", F.col("text_b")).agg(F.min("cid_b").alias("lo"), F.max("cid_b").alias("hi"), F.count("*").alias("n"))
    by_key = (
        a.where(~pairwise)
        .join(offers, ["kind", "key"])
        .where((F.col("kind") != "ini") | (F.col("text_a") == "") | (F.col("text_b") == "") | F.col("text_b").contains(F.col("text_a")))
        # the others: of three and more any two tell that there are several
        .select("cid_a", "kind", F.when((lo == me) & (n == 1), None).when((lo == me) & (n == 2), hi).otherwise(lo).alias("lo"), F.when((hi == me) & (n == 1), None).when((hi == me) & (n == 2), lo).otherwise(hi).alias("hi"))
    )
    stronger = F.struct("spellings_b", "count_b", "cid_b") > F.struct("spellings_a", "count_a", "cid_a")
    # hints seek by their one meaning, whatever their spellings
    rare = (F.col("spellings_a") <= MISTYPED) | (F.col("spellings_b") >= TIMES_SPELLINGS * F.col("spellings_a")) & (F.col("count_b") >= TIMES_ROWS * F.col("count_a"))
    mistyped = stronger & (rare | (F.col("role_a") == "h")) & _one_edit("text_a", "text_b")
    abbreviated = F.rlike(F.col("text_b"), F.col("text_a"))
    one_by_one = (
        a.where(pairwise)
        .join(b.where(pairwise), ["kind", "key"])
        .where((me != F.col("cid_b")) & F.when(F.col("kind") == "typo", mistyped).otherwise(abbreviated))
        .select("cid_a", "kind", F.col("cid_b").alias("lo"), F.col("cid_b").alias("hi"))
    )
    tier = F.create_map(*[F.lit(x) for item in TIERS.items() for x in item])[F.col("kind")]
    fits = by_key.unionByName(one_by_one).where("lo is not null").groupBy("cid_a", tier.alias("tier")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    first = fits.groupBy("cid_a").agg(F.min(F.struct("tier", "lo", "hi")).alias("m")).select("cid_a", "m.*")
    return first.where("lo = hi").select("cid_a", F.col("lo").alias("cid_b"), "tier")


def _one_hop(found: DataFrame) -> DataFrame:
    """The merges whose goal doesn't merge itself; there is one if there is any."""
    back = found.select(F.col("cid_a").alias("cid_b"), F.col("cid_b").alias("cid_a"), F.lit(True).alias("mutual"))
    one_way = found.join(back, ["cid_a", "cid_b"], "left").where("mutual is null or cid_b < cid_a").drop("mutual")
    rest = lambda f: f.join(f.select(F.col("cid_a").alias("cid_b")), "cid_b", "left_anti")
    settled = rest(one_way)
    # a ring of three and more: those that lead to a smaller id make none
    return rest(found.where("cid_b < cid_a")) if settled.isEmpty() else settled


def _one_edit(a: str, b: str) -> "F.Column":
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    distance = F.levenshtein(F.col(a), F.col(b), 2)
    return (distance == 1) | ((distance == 2) & (F.length(a) == F.length(b)) & (letters(a) == letters(b)))


def linked_pairs(links: DataFrame) -> DataFrame:
    """(name_a, name_b), a < b by code point: spellings of one entity."""
    a, b = links.withColumnRenamed("name", "name_a"), links.withColumnRenamed("name", "name_b")
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
