"""Personal information inside free text.

Method: regular expressions propose spans, checksum validators (Luhn, ISO 7064 mod 97 and mod 11,10, mod-23, mod-26 and mod-11 check characters) confirm or weaken
them, and nearby context words adjust the score; a span of at least `THRESHOLD` is a piece. Where spans overlap the higher score wins.
A number right behind a label of a personal document is a piece, less sure where its kind has a checksum that fails (people mistype numbers); without a label right before it, it needs its checksum, and
where the checksum is weak (one digit) a label nearby as well.

Names are proposed from a lexicon of given and family names that is learnt in three passes over all documents. Bylines and name fields
(`SEEDS`) give the first names. The words around these names elsewhere are counted: contexts that stand around at least `MIN_DISTINCT`
different known names are candidates. Then all name-shaped words in candidate contexts are counted: contexts in which at
least `MIN_KNOWN` of the occurrences are known names are kept, and the other names in them join the lexicon. So contexts are those of the corpus
at hand, in any language. A family name seen fewer than `MIN_NAMES` times scores less, so that it gives way to one seen often. A seed or kept context also
proposes the name that stands in it. All documents are then searched whole.

The lexicon is broadcast: a row per distinct given or family name; more than `MAX_LEXICON` are refused rather than cut. Contexts are
broadcast with it while they are at most `HELD_CONTEXTS`; more are joined by a shuffle with the contexts that stand in each text, so that none is left out.

Defined results: null and empty texts have no pieces and come out as they are; a piece that occurs several times is listed once per
text and replaced everywhere it was found; texts of any length are read whole; repeated rows are treated alike; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import checkpointed, counted_small

MIN_NAMES = 2
THRESHOLD = 1.0
RARE = 0.3  # what a family name seen fewer than `MIN_NAMES` times scores less
MIN_DISTINCT = 5
MIN_KNOWN = 0.9
HELD_CONTEXTS = 100_000  # contexts a worker holds; more are joined by a shuffle
MAX_LEXICON = 2_000_000

# --- checksums ---------------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 7064 mod 97-10 over a code whose first four characters move to its end."""
    moved = code[4:] + code[:4]
    return moved.isalnum() and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def mod23_letter(code: str) -> bool:
    """A number of 8 digits and its letter."""
    return code[:8].isdigit() and "TRWAGMYFPDXBNJZSQVHLCKE"[int(code[:8]) % 23] == code[8:9].upper()


def mod26_letter(code: str) -> bool:
    """A code of 15 letters and digits and its letter: those in odd places count by a table."""
    odd = (1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 2, 4, 18, 20, 11, 3, 6, 8, 12, 14, 16, 10, 22, 25, 24, 23)
    values = [int(c) if c.isdigit() else ord(c) - 65 for c in code]
    return sum(v if i % 2 else odd[v] for i, v in enumerate(values[:15])) % 26 == values[15]


def mod11_10(digits: str) -> bool:
    """ISO 7064 mod 11,10 over digits, the last one the check digit."""
    carry = 10
    for d in digits[:-1]:
        carry = 2 * ((int(d) + carry) % 10 or 10) % 11
    return (11 - carry) % 10 == int(digits[-1])


def mod11_digit(digits: str) -> bool:
    """Nine digits, the last one by falling weights mod 11."""
    return (11 - sum(int(d) * (9 - i) for i, d in enumerate(digits[:8])) % 11) % 11 % 10 == int(digits[8])


# --- mail addresses ----------------------------------------------------------------------------------------------------

AT = re.compile(r"@|[(\[{]\s?at\s?[)\]}]| at (?=[\w-]+(?: dot |\s?[\[({]\s?dot))", re.I)
LOCAL = re.compile(r"[\w.+%'-]+\s?$")
DOMAIN = re.compile(r"\s?[\w-]+(?:(?:\.|\s?[\[({]\s?dot\s?[)\]}]\s?| dot )[\w-]+)*(?:\.|\s?[\[({]\s?dot\s?[)\]}]\s?| dot )[^\W\d_]{2,}", re.I)


def mails(text: str) -> Iterator[tuple[int, int, float]]:
    for m in AT.finditer(text):
        left = LOCAL.search(text, max(0, m.start() - 80), m.start())
        right = DOMAIN.match(text, m.end())
        if left is None or right is None:
            continue
        start = left.start()
        while start < m.start() and text[start] in ".'-+%":
            start += 1
        if start < m.start() and (m[0] == "@" or text[m.start() - 1] != " " or m[0][0] in "([{"):
            yield start, right.end(), 2.0


# --- telephone numbers ------------------------------------------------------------------------------------------------

PHONE = re.compile(
    r"[+(0-9](?<![\w.,$€£%/@#°º-][+(0-9])(?:"
    r"(?<=\+)\d{1,3}[ .-]?(?:\(0\)\s?)?\(?\d[\d ./()-]{5,16}\d"
    r"|(?<=\()\d{3,5}\)[ ./-]?\d[\d .-]{4,12}\d"
    r"|(?<=0)0\d{2}[ .-]?\d[\d ./-]{5,14}\d"
    r"|(?<=0)\d{1,5}[ ./-]\d[\d ./-]{4,14}\d"
    r"|(?<=1)[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}"
    r"|\d{2}[ .-]\d{3}[ .-]\d{3,4}|\d{2}[ .-]\d{6}"
    r")(?!\d)(?:,?\s?(?:ext\.?|x|extension|Durchwahl|poste|int\.|interno|ramal)\s?\d{1,6})?"
)
PHONE_WORDS = re.compile(r"(?:tel|phone|fax|call|text|voice|mobile|cell|ring|joignable|appel|telefon|rufen|erreich|llam|ligu|chiam|teléfono|telefone|telefono|móvil|contact|dial)\w*\W+(?:\w+\W+){0,3}$", re.I)
NOT_PHONE = re.compile(r"(?:lot|serial|order|batch|form|exhibit|isin|route|firmware|file|invoice|purchase|number|nr|no|ticket|case|ref|account|range|version|item|social|security|ssn|passport|id|dni|fiscal|steuer-id|license|licence|von|from|bis)\W{1,3}(?:n[.°º]+\s?)?$", re.I)


def phones(text: str) -> Iterator[tuple[int, int, float]]:
    for m in PHONE.finditer(text):
        number = re.split(r"[a-zA-Z]", m[0], maxsplit=1)[0]
        digits = re.sub(r"\D", "", number)
        if not 9 <= len(digits) <= 15:
            continue
        before = text[max(0, m.start() - 40) : m.start()]
        score = 0.6 + 0.4 * (number[0] in "+(") + 0.4 * number.startswith(("00", "0")) + 0.6 * bool(re.fullmatch(r"(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}", number.strip(" ,")))
        score += 0.8 * bool(PHONE_WORDS.search(before)) - 2.0 * bool(NOT_PHONE.search(before)) + 0.3 * (m[0] != number)
        if re.fullmatch(r"\d{2}([.-])\d{2}\1\d{4}|\d{4}([.-])\d{2}\2\d{2}", number):
            score -= 2
        if number[0] not in "+(0" and score < 1.0 and re.fullmatch(r"\d{3}[ .-]\d{3}[ .-]\d{3}|\d{3}[ .-]\d{6}", number):
            score += 0.5 * (before.rstrip()[-1:] in ("", ",", ":", ";") or before.endswith("\n"))
        end = m.end()
        while text[end - 1] in " ,.-/(":
            end -= 1
        yield m.start(), end, score


# --- numbers of personal documents --------------------------------------------------------------------------------

#: What documents of persons are called, in lower case, under the stem that is looked for first.
ID_LABELS = {
    "social sec": ("social security",), "ssn": ("ssn",), "passport": ("passport",), "passeport": ("passeport",), "reisepass": ("reisepass",), "pasaporte": ("pasaporte",),
    "passap": ("passaporto", "passaporte"), "licen": ("driver's license", "driver’s license", "drivers license", "driver license", "driver's licence", "driver’s licence", "driving licence", "driving license"),
    "führerschein": ("führerschein",), "permis": ("permiso de conducir", "permis de conduire"), "patente": ("patente di guida", "patente"), "carta": ("carta de condução", "carta d'identità", "carta d’identità"),
    "national id": ("national identity card", "national identity", "national id card", "national id"), "identity card": ("identity card",), "carte d": ("carte d'identité", "carte d’identité"), "cartão": ("cartão de cidadão",),
    "ausweis": ("personalausweis",), "dni": ("dni",), "nif": ("nif",), "nie ": ("nie",), "fiscal": ("codice fiscale", "numéro fiscal", "numero fiscal", "número fiscal", "identificação fiscal", "identifiant fiscal"),
    "steuer": ("steueridentifikationsnummer", "steuer-identifikationsnummer", "steuernummer", "steuer-id"), "tax i": ("tax identification", "tax id"), "tax n": ("tax number",), "seguridad soc": ("seguridad social",), "sécurité soc": ("sécurité sociale",), "sozialvers": ("sozialversicherungsnummer",),
}
ID_AFTER = re.compile(r"(?:[- ]?(?:number|no\.?|nr\.?|n°|n\.º|n\.|nº|num\.?|número|numéro|numero|nummer|id|card|#)(?![A-Za-z0-9]))*\s*[:#]?\s*", re.I)
ID_VALUE = re.compile(r"(?:[A-Z0-9]{1,16}(?:[-/. ](?=[A-Z0-9]*\d)|-(?=[A-Z]\b)))*[A-Z0-9]+(?![a-zà-ÿ])")


def _dni(c: str) -> bool:
    return mod23_letter({"X": "0", "Y": "1", "Z": "2"}.get(c[0], c[0]) + c[1:])


#: Kinds of number that have a checksum: the form without separators, and the check.
CHECKS = (
    (re.compile(r"(?:\d{8}|[XYZ]\d{7})[A-Z]"), _dni),
    (re.compile(r"[A-Z]{6}\d{2}[ABCDEHLMPRST]\d{2}[A-Z]\d{3}[A-Z]"), mod26_letter),
    (re.compile(r"[12]\d{14}"), lambda c: 97 - int(c[:13]) % 97 == int(c[13:])),
    (re.compile(r"\d{11}"), mod11_10),
    (re.compile(r"[A-Z]{2}\d{2}[A-Z0-9]{10,30}"), mod97),
)
LABELLED, SOUND, UNSOUND = 2.2, 0.3, -0.5


def checked(code: str) -> float:
    """What a number's checksum adds to its score: nothing where its form has none."""
    for form, sound in CHECKS:
        if form.fullmatch(code):
            return SOUND if sound(code) else UNSOUND
    return 0.0


def stems_in(lower: str) -> list[str]:
    return [stem for stem in ID_LABELS if stem in lower]


def id_numbers(text: str, lower: str, stems: list[str]) -> Iterator[tuple[int, int, float]]:
    for stem in stems:
        for label in ID_LABELS[stem]:
            place = lower.find(label)
            while place >= 0:
                start, place = place, lower.find(label, place + len(label))
                if start and lower[start - 1].isalnum():
                    continue
                v = ID_VALUE.match(text, ID_AFTER.match(text, start + len(label)).end())
                if v is None:
                    continue
                plain = re.sub(r"[^A-Z0-9]", "", v[0])
                digits = sum(c.isdigit() for c in plain)
                if digits >= 5 and 6 <= len(plain) <= 20:
                    yield v.start(), v.end(), LABELLED + checked(plain)


#: Shapes of numbers of personal documents, found without a label; which check each has, and whether it is a weak one (one digit in ten is right by chance).
ID_SHAPES = (
    (re.compile(r"[\dXYZ](?<![\w./-][\dXYZ])(?:(?<=\d)\d{7}|(?<=[XYZ])-?\d{7})-?[A-Z](?![\w-])"), _dni, False),
    (re.compile(r"[A-Z](?<![\w-][A-Z])[A-Z]{5}\d{2}[ABCDEHLMPRST]\d{2}[A-Z]\d{3}[A-Z](?![\w-])"), mod26_letter, False),
    (re.compile(r"[12](?<![\w.,/+-][12]) ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3} ?\d{2}(?![\w-])(?![.,]\d)"), lambda c: 97 - int(c[:13]) % 97 == int(c[13:]), False),
    (re.compile(r"\d(?<![\w.,/+$€£-]\d)\d{2}-\d{2}-\d{4}(?![\w-])(?![.,]\d)"), None, False),
    (re.compile(r"\d(?<![\w.,/+$€£-]\d)\d ?\d{3} ?\d{3} ?\d{3}(?![\w-])(?! ?\d)(?![.,]\d)"), mod11_10, True),
    (re.compile(r"[1235689](?<![\w.,/+$€£-]\d)\d{2} ?\d{3} ?\d{3}(?![\w-])(?! ?\d)(?![.,]\d)"), mod11_digit, True),
)
ID_WORD = re.compile(r"(?<![^\W\d_])(?:" + "|".join(sorted((re.escape(x) for labels in ID_LABELS.values() for x in labels), key=len, reverse=True)) + r")(?![^\W\d_])")


def unlabelled_ids(text: str, lower: str, stems: list[str]) -> Iterator[tuple[int, int, float]]:
    """Numbers by their shape alone: below the threshold unless the checksum is right or, for a shape without one, a label is near; a weak checksum needs both."""
    for shape, sound, weak in ID_SHAPES:
        if not stems and (weak or sound is None):  # these need a label
            continue
        for m in shape.finditer(text):
            good = sound is not None and sound(re.sub(r"[^A-Z0-9]", "", m[0]))
            if weak and not good:
                continue
            near = ID_WORD.search(lower[max(0, m.start() - 50) : m.start()])
            yield m.start(), m.end(), (0.2 if weak else 0.6) + (0.5 * good if sound else 0.0) + (0.5 if near and (good or sound is None) else 0.3 if near else 0.0)


# --- street addresses --------------------------------------------------------------------------------------------------

_CAP = r"[A-ZÀ-ÖØ-Þ][\w’'-]*"
#: The patterns begin with the last digit of the house number, which is then extended to the left.
EN_STREET = re.compile(
    rf"\d[A-Z]? (?:(?:[NSEW]\.?|North|South|East|West|NE|NW|SE|SW) )?(?:{_CAP} ){{1,4}}(?:Street|Road|Drive|Avenue|Boulevard|Lane|Court|Terrace|Place|Way|St\.?|Rd\.?|Dr\.?|Ave\.?|Blvd\.?|Ln\.?|Ct\.?)(?![\w-])"
    r"(?:,? (?:Unit|Apt\.?|Apartment|Suite|Ste\.?|Flat|#) ?\w+)?",
)
FR_STREET = re.compile(rf"\d(?: ?(?:bis|ter|quater)\b)?,? (?:[rR]ue|[aA]venue|[iI]mpasse|[bB]oulevard|[cC]hemin|[pP]lace|[qQ]uai|[aA]llée|[cC]ours|[sS]quare|[pP]assage) (?:(?:de la|de l['’]|des|du|de|d['’]) ?)?{_CAP}(?:[ -](?:(?:de|du|des|la|le) )?{_CAP})*")
ROMANCE_KINDS = ("Calle ", "Avenida ", "Avda", "Paseo ", "Plaza ", "Camino ", "Ronda ", "Rua ", "Travessa ", "Largo ", "Praça ", "Via ", "Viale ", "Piazza ", "Corso ", "Vicolo ")
ROMANCE = re.compile(rf"\b(?:Calle|Avenida|Avda\.?|Paseo|Plaza|Camino|Ronda|Rua|Travessa|Largo|Praça|Via|Viale|Piazza|Corso|Vicolo) (?:(?:de la|de los|de las|del|della|delle|dei|degli|dell['’]|de|do|da|dos|das|di|d['’]|la|el) ?)*{_CAP}(?: (?:(?:de|do|da|del|della|y|e) )?{_CAP})*,?(?: (?:n\.?º|nº|n\.|núm\.|num\.|n°))? ?\d{{1,5}}[a-zA-Z]?(?!\w)")
DE_NUMBER = re.compile(r"(?:stra(?:ß|ss)e|str\.|weg|gasse|allee|platz|ring|damm|ufer|stieg|pfad|chaussee|hof|graben|markt) \d{1,4}(?: ?[a-z](?!\w))?")
DE_PLACE = re.compile(rf"\b(?:Am|An der|An den|Auf dem|Auf der|Zum|Zur|Unter den|Hinter dem|Hinter der|Vor dem|Beim|Bei der) (?!(?:Jahr|Quartal|Halbjahr|Ende|Anfang|Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Montag|Dienstag|Mittwoch|Donnerstag|Freitag|Samstag|Sonntag)\b){_CAP} \d{{1,4}}(?: ?[a-z])?(?![\w%,.]*\d|\w)")
DE_STEMS = ("traße ", "trasse ", "str. ", "weg ", "gasse ", "allee ", "platz ", "ring ", "damm ", "ufer ", "stieg ", "pfad ", "chaussee ", "hof ", "graben ", "markt ")
DE_PLACES = ("Am ", "An de", "Auf de", "Zum ", "Zur ", "Unter den ", "Hinter de", "Vor dem ", "Beim ", "Bei der ")
DE_BEFORE = re.compile(rf"(?:(?:Alte|Alter|Altes|Neue|Neuer|Neues|Am|An der|Auf dem|Große|Kleine|Obere|Untere|Lange|Kurze|Hintere|Vordere) )?{_CAP}$")


def addresses(text: str) -> Iterator[tuple[int, int, float]]:
    for pattern in (EN_STREET, FR_STREET):
        for m in pattern.finditer(text):
            start = m.start()
            while start and text[start - 1].isdigit():
                start -= 1
            if m.start() - start < 5 and not (start and (text[start - 1].isalnum() or text[start - 1] in "$€£.,-")):
                yield start, m.end(), 1.8
    if any(s in text for s in ROMANCE_KINDS):
        for m in ROMANCE.finditer(text):
            yield m.start(), m.end(), 1.7
    for m in DE_PLACE.finditer(text) if any(x in text for x in DE_PLACES) else ():
        yield m.start(), m.end(), 1.6
    for m in DE_NUMBER.finditer(text) if any(x in text for x in DE_STEMS) else ():
        left = DE_BEFORE.search(text, max(0, m.start() - 40), m.start())
        if left:
            yield left.start(), m.end(), 1.7


# --- names --------------------------------------------------------------------------------------------------------------

_PART = r"(?:[A-ZÀ-ÖØ-Þ][\w’'-]+|[A-ZÀ-ÖØ-Þ]\.|d[eior]|der|den|van|von|Mc|Mac)"
_FULL = rf"([A-ZÀ-ÖØ-Þ][\w’'-]+(?: {_PART}){{1,4}})"
FULL = re.compile(_FULL + r"(?!\w)")
#: Forms that name a person in texts of any kind, each after the texts of which one is in every match.
SEEDS = tuple(
    (stems, re.compile(p.replace("NAME", _FULL), re.M))
    for stems, p in ((("By ", "Von ", "Par ", "Por ", "Di ", "Da "), r"^(?:By|Von|Par|Por|Di|Da) NAME$"), (("Name: ", "Nom: ", "Nom : ", "Nombre: ", "Nome: "), r"\b(?:Name|Nom|Nombre|Nome) ?: NAME(?=[;,\n]|$)"))
)
BLANK = (" ", "\u00a0")
LEFT, RIGHT = re.compile(r"(?:(\S+)[  ])?(\S+?)[  ]?$"), re.compile(r"[  ]?([\w’'-]+|[^\w\s])")
TITLES = re.compile(r"(?:\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Herr|Herrn|Frau|M|Mme|Mlle|Monsieur|Madame|Maître|Sr|Sra|Señor|Señora|Don|Doña|Sig|Sig\.ra|Signor|Signora|Dott|Dott\.ssa|Avv|Senhor|Senhora|Dona|Doutor|Doutora|Dottor|Dottoressa|Doctor|Doctora|Docteur|Doktor|Ingegner|Avvocato|Maestro|Lord|Lady|Judge|Senator|Professor|Professeur|Professore)\.? (?:Dr\.? |Prof\.? )?)$", re.I)
NOT_PERSON_AFTER = re.compile(r"(?:['’]s)? (?:&|and Sons|y Hijos|Trust|Foundation|Fund|Fonds|Capital(?! spending)|Partners|Holdings?|Group|Inc|Corp|Corporation|Ltd|LLC|GmbH|AG|SA|Robotics|Energy|Systems|Labs|Bank|Institute|University|Award|Prize|Center|Centre|Street|St\b|Road|Drive|Avenue|Ave|Blvd|Lane|Court|Stiftung|Estate|Family|Brothers|Bros)")
NOT_PERSON_IN = re.compile(NOT_PERSON_AFTER.pattern + r"(?![\w’'-])")
NOT_PERSON_BEFORE = re.compile(r"\b(?:Port|Fort|Mount|Lake|Saint|St\.|San|Santa|Camp|Cape|Point|Fondazione|Stiftung|Fundación|Fondation|Fundação)\s$")
WORD = re.compile(r"[^\W\d_]+")
CAPITALISED = re.compile(r"[A-ZÀ-ÖØ-Þ][^\W\d_]+")


@dataclass
class Lexicon:
    given: frozenset[str]
    family: frozenset[str]
    rare: frozenset[str] = frozenset()  # the family names that were seen few times
    contexts: Contexts = field(default_factory=lambda: Contexts())
    tails: dict[str, tuple[str, ...]] = field(default_factory=dict)  # last word in lower case to the family names that end with it, longest first

    def __post_init__(self) -> None:
        tails: dict[str, list[str]] = {}
        capitals = {n.upper().lower() for n in self.family if n.upper().lower() != n.lower()}  # as written in capitals, ß as SS
        for name in [*self.family, *sorted(capitals)]:
            tails.setdefault(WORD.findall(name)[-1].lower(), []).append(name)
        self.tails = {k: tuple(sorted(v, key=len, reverse=True)) for k, v in tails.items()}
        self.given_lower = frozenset(x for g in self.given for x in (g.lower(), g.upper().lower()))
        self.family_lower = frozenset(f.lower() for f in self.family)
        self.rare_lower = frozenset(x for f in self.rare for x in (f.lower(), f.upper().lower()))


def split_name(name: str) -> tuple[list[str], str]:
    """Given names and the family name; initials belong to neither."""
    words = name.split(" ")
    k = 1
    while k < len(words) - 1 and (len(words[k]) == 2 and words[k][1] == "."):
        k += 1
    return words[0].split("-"), " ".join(words[k:])


def in_seeds(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and text of the names in bylines and name fields."""
    for stems, seed in SEEDS:
        if any(x in text for x in stems):
            for m in seed.finditer(text):
                if not m[1].isupper():
                    yield m.start(1), m.end(1), m[1]


def around(text: str, start: int, end: int) -> str | None:
    """The context of a name: the two words before it and what follows it, within its line; null where nothing comes before."""
    line = text.rfind("\n", max(0, start - 40), start) + 1 or max(0, start - 40)
    left = LEFT.search(text, line, start)
    if left is None:
        return None
    right = RIGHT.match(text, end)
    return f"{(left[1] or '').lower()} {left[2].lower()} _ {right[1].lower() if right else ''}"


class Contexts(frozenset):
    """Contexts, and the pairs of characters next to a name that any of them has, by which most name-shaped words are passed over."""

    @cached_property
    def sides(self) -> frozenset[str]:
        halves = (c.rsplit(" _ ", 1) for c in self)
        return frozenset(left[-1] + right[:1] for left, right in halves)


def _side(text: str, place: int) -> str:
    c = text[place : place + 1]
    return "" if c.isspace() else c.lower()


def in_contexts(text: str, contexts: Contexts | None) -> Iterator[tuple[int, int, str, str]]:
    """Start, end, text and context of the name-shaped words in the given contexts, or in any if these are null."""
    if contexts is None or contexts:
        sides = contexts.sides if contexts is not None else None
        for m in FULL.finditer(text):
            start, end = m.span()
            before = start - 1 - (text[start - 1 : start] in BLANK)
            if before >= 0 and (sides is None or _side(text, before) + _side(text, end + (text[end : end + 1] in BLANK)) in sides) and not m[1].isupper():
                context = around(text, start, end)
                if context if contexts is None else context in contexts:
                    yield start, end, m[1], context


def fit_lexicon(given: dict[str, int], family: dict[str, int], min_names: int = MIN_NAMES, contexts: Iterable[str] = ()) -> Lexicon:
    """The lexicon of counted given and family names; a family name that ends with a more frequent one is that one after a middle name."""
    kept = {n for n, c in family.items() if not any(family.get(n[k + 1 :], 0) > c for k in range(len(n)) if n[k] == " ")}
    return Lexicon(frozenset(given), frozenset(kept), frozenset(n for n in kept if family[n] < min_names), Contexts(contexts))


GIVEN_BEFORE = re.compile(r"(?<![^\W_])((?:(?:[A-ZÀ-ÖØ-Þ][\w’']*(?:-[A-ZÀ-ÖØ-Þ][\w’']*)*|[A-ZÀ-ÖØ-Þ]\.(?:-?[A-ZÀ-ÖØ-Þ]\.)?)[  ])+)$")
GIVEN_AFTER = re.compile(r",[  ]([A-ZÀ-ÖØ-Þ][\w’']*(?:-[A-ZÀ-ÖØ-Þ][\w’']*)*(?:[  ][A-ZÀ-ÖØ-Þ]\.)*)(?![\w@])")


def names(text: str, lower: str, lexicon: Lexicon, contexts: Contexts | None = None) -> Iterator[tuple[int, int, float]]:
    """Family names of the lexicon with given names or initials before or after them, or with a title before them; names in seeds and in contexts, those of the lexicon if none are given."""
    for tail in lexicon.tails.keys() & {w.lower() for w in set(CAPITALISED.findall(text))}:
        place = lower.find(tail)
        while place >= 0:
            end = place + len(tail)
            here, place = place, lower.find(tail, end)
            if lower[end : end + 1].isalnum() or lower[end : end + 1] in ("@", "_"):
                continue
            for family in lexicon.tails[tail]:
                start = end - len(family)
                if start >= 0 and lower[start:end] == family.lower() and not (start and (lower[start - 1].isalnum() or lower[start - 1] in "@._+")):
                    break
            else:
                continue
            written = text[start:end]
            if not written[0].isupper() and not written.split(" ")[-1][0].isupper() or NOT_PERSON_AFTER.match(text, end):
                continue
            less = RARE * (family.lower() in lexicon.rare_lower)
            left = text[max(0, start - 60) : start]
            before = GIVEN_BEFORE.search(left)
            if before:
                words = before[1].split()
                k = len(words)
                while k and _is_given(words[k - 1], lexicon):
                    k -= 1
                if k < len(words):
                    first = start - len(before[1]) + sum(len(w) + 1 for w in words[:k])
                    if not NOT_PERSON_BEFORE.search(text[max(0, first - 12) : first]):
                        yield first, end, 1.6 - less
                    continue
            after = GIVEN_AFTER.match(text, end)
            if after and all(_is_given(w, lexicon) for w in after[1].split()) and len(after[1].split()[0].rstrip(".")) > 1:
                rest = text[after.end() : after.end() + 40]
                follows = rest.strip().lower()
                if not re.match(r"[  ](?:[A-ZÀ-ÖØ-Þ]\.\s)?[A-ZÀ-ÖØ-Þ][\w’'-]+", rest) or not any(follows[:k] in lexicon.family_lower for k in range(1, len(follows) + 1)):
                    yield start, after.end(), 1.5 - less
                    continue
            if TITLES.search(left):
                yield start, end, 1.4 - less
    for start, end, name, *_ in chain(in_seeds(text), in_contexts(text, lexicon.contexts if contexts is None else contexts)):
        if name.lower() not in lexicon.family_lower and not NOT_PERSON_AFTER.match(text, end) and not NOT_PERSON_IN.search(name):
            yield start, end, 1.05


def _is_given(word: str, lexicon: Lexicon) -> bool:
    if word.endswith("."):
        return len(word) <= 5
    return all(p.lower() in lexicon.given_lower for p in word.split("-"))


# --- together -------------------------------------------------------------------------------------------------------------

KINDS = ("email", "phone", "id_number", "address", "name")


def pieces(text: str, lexicon: Lexicon, contexts: Contexts | None = None) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the pieces of one text, not overlapping, in order; `contexts` are the text's own where the lexicon can't hold all."""
    lower, found = text.lower(), []
    if len(lower) != len(text):  # a letter whose lower case is longer
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    stems = stems_in(lower)
    if "@" in text or "at)" in lower or "at]" in lower or "at}" in lower or " dot " in lower or "dot]" in lower:
        found += [(s, -(e - b), b, e, "email") for b, e, s in mails(text)]
    found += [(s, -(e - b), b, e, "phone") for b, e, s in phones(text)]
    found += [(s, -(e - b), b, e, "id_number") for b, e, s in id_numbers(text, lower, stems)]
    found += [(s, -(e - b), b, e, "id_number") for b, e, s in unlabelled_ids(text, lower, stems)]
    found += [(s, -(e - b), b, e, "address") for b, e, s in addresses(text)]
    found += [(s, -(e - b), b, e, "name") for b, e, s in names(text, lower, lexicon, contexts)]
    taken: list[tuple[int, int, str]] = []
    for score, _, b, e, kind in sorted((f for f in found if f[0] >= THRESHOLD), key=lambda f: (-f[0], f[1], f[2])):
        if not any(b < y and x < e for x, y, _ in taken):
            taken.append((b, e, kind))
    return sorted(taken)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, place = [], 0
    for b, e, kind in spans:
        out += [text[place:b], f"<{kind.upper()}>"]
        place = e
    return "".join([*out, text[place:]])


def _is_known(name: str, lexicon: Lexicon) -> bool:
    given, family = split_name(name)
    return family.lower() in lexicon.family_lower and all(g.lower() in lexicon.given_lower for g in given)


def _parts_of(names_: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """Counted given and family names of (name, n, given, family); at most `MAX_LEXICON` of them come to the driver."""
    whole = names_.groupBy("name").agg(F.sum("n").alias("n"), F.max("given").alias("given"), F.max("family").alias("family"))
    twice = names_.select(F.col("family").alias("name")).filter(F.col("family").contains(" ")).distinct()
    # a name that is as a whole a family name of two words has no given name
    parted = whole.join(twice, "name", "left_anti").filter((F.length("family") > 2) & (F.substring("family", 2, 1) != "."))
    parts = F.concat(F.array(F.struct(F.lit(True).alias("is_family"), F.col("family").alias("part"))), F.transform(F.split("given", "-"), lambda g: F.struct(F.lit(False).alias("is_family"), g.alias("part"))))
    counted = parted.select("n", F.explode(parts).alias("p")).groupBy("p.is_family", "p.part").agg(F.sum("n").alias("n")).limit(MAX_LEXICON + 1).collect()
    if len(counted) > MAX_LEXICON:
        raise ValueError(f"more than {MAX_LEXICON} names: raise the bound, or split the table")
    return {r.part: r.n for r in counted if not r.is_family}, {r.part: r.n for r in counted if r.is_family}


_NAMES = "context string, name string, known boolean, n bigint, given string, family string"


def _held(contexts: DataFrame) -> Contexts | None:
    """The contexts if they were counted to be few enough for a worker to hold, else null."""
    rows = contexts.limit(HELD_CONTEXTS + 1).collect()
    return Contexts(r.context for r in rows) if len(rows) <= HELD_CONTEXTS else None


def fitted(df: DataFrame, *, text_col: str = "text") -> tuple[Lexicon, DataFrame | None]:
    """The lexicon of a table, and its contexts apart as (context) where they are more than it can hold: names of bylines and name fields, then the contexts these names stand in, then the names in those contexts; three passes over all documents."""
    spark = df.sparkSession
    texts = df.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))

    def counted(found: Callable[[str], Iterator[tuple[str, str, bool]]]) -> DataFrame:
        """(context, name, known, n, given, family) summed over each batch."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sums = Counter(x for t in batch.column(0).to_pylist() for x in found(t))
                rows = [(*key, n, "-".join(given), family) for key, n in sums.items() for given, family in (split_name(key[1]),)]
                kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["context", "name", "known", "n", "given", "family"])

        return texts.mapInArrow(run, _NAMES)

    seeds = checkpointed(counted(lambda t: (("", name, True) for _, _, name in in_seeds(t))))
    first = spark.sparkContext.broadcast(fit_lexicon(*_parts_of(seeds)))
    if not first.value.family:
        return first.value, None

    def of_known(text: str) -> Iterator[tuple[str, str, bool]]:
        given = first.value.given_lower
        for m in FULL.finditer(text):
            if m[1].split(" ", 1)[0].split("-", 1)[0].lower() in given and not m[1].isupper() and _is_known(m[1], first.value):
                context = around(text, m.start(), m.end())
                if context:
                    yield context, m[1], True

    each = counted(of_known).select("context", "name").distinct()
    candidates = checkpointed(each.groupBy("context").agg(F.count("*").alias("names")).filter(F.col("names") >= MIN_DISTINCT).select("context"))
    tried = spark.sparkContext.broadcast(_held(candidates))

    def in_tried(text: str) -> Iterator[tuple[str, str, bool]]:
        for _, _, name, context in in_contexts(text, tried.value):
            yield context, name, _is_known(name, first.value)

    found = counted(in_tried)
    if tried.value is None:
        found = found.join(candidates, "context", "left_semi")
    there = checkpointed(found.groupBy("context", "name", "known", "given", "family").agg(F.sum("n").alias("n")))
    share = F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)) / F.sum("n")
    kept = checkpointed(there.groupBy("context").agg(share.alias("share")).filter(F.col("share") >= MIN_KNOWN).select("context"))
    more = there.join(counted_small(kept, HELD_CONTEXTS), "context", "left_semi")
    held = _held(kept)
    return fit_lexicon(*_parts_of(seeds.unionByName(more)), contexts=held or ()), kept if held is None else None


def fitted_lexicon(df: DataFrame, *, text_col: str = "text") -> Lexicon:
    """The lexicon of a table with all its contexts, however many."""
    lexicon, apart = fitted(df, text_col=text_col)
    if apart is not None:
        lexicon.contexts = Contexts(r.context for r in apart.collect())
    return lexicon


def _with_contexts(rows: DataFrame, apart: DataFrame | None) -> DataFrame:
    """(key, text) and, where the contexts are apart from the lexicon, those of them that the text has."""
    if apart is None:
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [(d, c) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for c in {x[3] for x in in_contexts(t, None)}]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in each], pa.string()) for k in (0, 1)], names=["digest", "context"])

    keyed = rows.withColumn("digest", F.sha2("text", 256))
    there = keyed.filter(F.col("text").isNotNull()).select("digest", "text").mapInArrow(run, "digest string, context string").distinct()
    own = there.join(apart, "context", "left_semi").groupBy("digest").agg(F.collect_list("context").alias("contexts"))
    return keyed.join(own, "digest", "left").select("key", "text", "contexts")


def _read(batch: pa.RecordBatch) -> Iterator[tuple[str | None, Contexts | None]]:
    """Each text and its own contexts: null where the lexicon holds all."""
    texts = batch.column(1).to_pylist()
    return zip(texts, (Contexts(x or ()) for x in batch.column(2).to_pylist()) if batch.num_columns > 2 else [None] * len(texts))


def find_pieces(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, kind, value): each distinct piece of each text."""
    lexicon, apart = fitted(df, text_col=text_col)
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, kind, value = [], [], []
            for i, (text, own) in enumerate(_read(batch)):
                if text:
                    for k, v in sorted({(k, text[b:e]) for b, e, k in pieces(text, shared.value, own)}):
                        row.append(i), kind.append(k), value.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(kind, pa.string()), pa.array(value, pa.string())], names=["key", "kind", "value"])

    name = df.schema[id_col].dataType.simpleString()
    return _with_contexts(df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")), apart).mapInArrow(run, f"key {name}, kind string, value string").withColumnRenamed("key", id_col)


def redact(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, pieces): the text with typed placeholders, and its number of pieces; null stays null."""
    lexicon, apart = fitted(df, text_col=text_col)
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [(t, pieces(t, shared.value, own) if t else []) for t, own in _read(batch)]
            spans = [s for _, s in each]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([redacted(t, s) if t else t for t, s in each], pa.string()), pa.array([len(s) for s in spans], pa.int32())], names=["key", "text", "pieces"])

    name = df.schema[id_col].dataType.simpleString()
    return _with_contexts(df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")), apart).mapInArrow(run, f"key {name}, text string, pieces int").withColumnRenamed("key", id_col)
