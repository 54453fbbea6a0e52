"""Personal information inside free text: find it and replace it with typed placeholders.

Patterns propose spans, validators confirm numbers (Luhn, ISO 7064 mod 97 and mod 11,10, national check digits), context
words close before a span raise or lower its score, and spans that reach the threshold are kept; of overlapping ones the
stronger type.

Names have no pattern of their own and no list of names is used. Pairs of capitalised words, single words after a form of
address, list items, signatures and the like are candidates. The corpus tells which words are names: for every word it is
counted in how many documents it stands first (last) in a candidate, and in how many of those something else than its shape
says that this is a person (form of address, title, greeting, signature, label, an e-mail address of the same parts). The
log odds of its two words, moved by the words around it, are the score of a candidate. A word that was hardly seen stays
open and shape and context decide; a word seen often without such evidence (nouns, towns, firms) is none.

The texts pass once through an Arrow-batched function; candidates, never texts, are shuffled to meet the counts of their
words. Null, empty and blank texts hold nothing. A piece that occurs several times in a document is one piece.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.memo import memo
from tidewright.session import checkpointed

THRESHOLD = 0.5
TYPES = ["email", "id_number", "phone", "address", "name"]
#: Least log odds of a pair of words, and of a single word, to be a name.
PAIR, LONE = -4.3, -1.3
#: Log odds of an initial as a first name.
INITIAL = -1.0

# Forms of address, titles, greetings, closings, labels of persons, particles of family names.
SALUTATIONS = {"frau", "herr", "herrn", "fr", "hr", "mrs", "mr", "ms", "miss", "mme", "madame", "monsieur", "mlle", "mademoiselle", "señor", "señora", "signor", "signora"}
TITLES = {"dr", "prof", "professor", "professorin", "dipl", "ing", "mag", "med", "phil", "jur", "rer", "nat", "sir", "dame", "rev", "pfarrer", "pastor"}
GREETINGS = {"liebe", "lieber", "liebes", "hallo", "hi", "dear", "hello", "bonjour", "bonsoir", "cher", "chère", "chere", "moin", "servus", "salut", "hey", "morgen", "tag", "abend", "morning"}
CLOSINGS = set("grüße grüsse gruß gruss grüßen grüssen regards wishes best herzlich herzlichst freundlich cordialement salutations cheers thanks danke dank merci mfg lg vg sincerely yours faithfully truly vous amitiés --".split())
LABELS = {
    "name", "vorname", "nachname", "familienname", "nom", "prénom", "kontakt", "kontaktperson", "contact", "ansprechpartner", "ansprechpartnerin", "ansprechperson", "inhaber", "inhaberin", "geschäftsführer",
    "geschäftsführerin", "geschäftsführung", "vertreten", "autor", "autorin", "author", "verantwortlich", "unterschrift", "gezeichnet", "signed", "signature", "gez", "absender", "empfänger", "notiz", "teilnahme",
    "teilnehmer", "teilnehmerin", "teilnehmende", "anwesend", "anwesende", "participants", "participant", "attendees", "présents", "present", "dabei", "gäste", "von", "from", "to", "cc", "protokoll", "moderation", "leitung",
    "z.hd", "zhd", "hd", "attn", "sprecher", "sprecherin", "trainer", "trainerin", "referent", "referentin",
}
PARTICLES = r"(?:von|van|de|di|du|da|del|della|zu|zum|zur|ter|ten|af|la|le|el|al|bin|ibn|dos|das)(?: (?:der|den|dem|la|las|los))?"
# Words that name groups, roles, days and the like and are no part of a name.
NO_NAME = {
    "empfang", "team", "vorstand", "koordination", "redaktion", "die", "der", "das", "den", "dem", "des", "ein", "eine", "einen", "einem", "einer", "the", "all", "alle", "kolleginnen", "kollegen", "nachbarn", "freunde",
    "freundinnen", "damen", "herren", "mitglieder", "und", "and", "et", "gäste", "interessierte", "sir", "madam", "everyone", "colleagues", "friends", "neighbours", "members", "partner", "organisation", "verein",
    "kunde", "kundin", "kunden", "projekt", "betreff", "subject", "telefon", "adresse", "anschrift", "kontakt", "contact", "email", "e-mail", "mail", "tel", "fax", "für", "bei", "von", "zum", "zur", "im", "am", "to", "for",
    "at", "on", "with", "list", "order", "gmbh", "ggmbh", "ag", "eg", "ug", "gbr", "kg", "ohg", "ev", "e.v", "mbh", "ltd", "inc", "sarl", "haftungsbeschränkt", "bitte", "please", "montag", "dienstag", "mittwoch",
    "donnerstag", "freitag", "samstag", "sonntag", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september",
    "oktober", "november", "dezember", "january", "february", "march", "may", "june", "july", "october", "december", "ich", "wir", "sie", "er", "es", "i", "we", "you", "he", "she", "it", "they", "my", "our", "your",
    "unsere", "unser", "ihre", "ihr", "mein", "meine", "le", "la", "les", "un", "une", "nous", "vous", "in", "an", "auf", "mit", "laut", "nach", "vor", "über", "unter", "call", "ask", "heute", "morgen", "gestern", "today",
    "tomorrow", "yesterday", "straße", "strasse", "street", "road", "avenue", "platz", "weg", "allee", "steuer-id", "iban", "isbn", "nr", "pass", "dear", "hallo", "hi", "from", "when", "what", "where", "why", "how",
    "grüße", "grüsse", "gruß", "gruss", "grüßen", "viele", "beste", "besten", "herzliche", "freundliche", "freundlichen", "liebe", "regards", "kind", "best", "thanks", "danke", "merci", "wishes",
    "there", "here", "this", "that", "these", "those", "wenn", "dann", "aber", "oder", "auch", "nur", "noch", "schon", "wie", "was", "wer", "wo",
}
ORG_FORMS = {"gmbh", "ggmbh", "ag", "eg", "ug", "gbr", "kg", "ohg", "mbh", "ltd", "inc", "llc", "sarl", "se", "kgaa"}
STREET_TYPES = r"(?:stra(?:ß|ss)e|str\.?|weg|allee|platz|pl\.|gasse|damm|ring|ufer|steig|chaussee|pfad|promenade)"
# Verbs whose subject is mostly a person, words that stand before persons, and words that stand before things.
PERSON_VERBS = set(
    "sagt sagte meint fragt fragte ruft rief schreibt schrieb bittet bat übernimmt übernahm meldet meldete kommt kam geht ging hat hatte ist war wird will kann muss möchte bringt brachte gibt gab hilft half leitet leitete "
    "wohnt arbeitet dankt berichtet erklärt erzählt holt says said asks asked calls called writes wrote thinks met has had is was will can brought brings promised promises comes came went lives works leads told tells "
    "wants helped needs dit demande appelle écrit pense vient a est habite travaille".split()
)
BEFORE_PERSON = set("an von mit bei durch sich sagt fragt fragen frage an ist und sowie oder by with from to ask asked met call called thanks thank and or is for avec par de chez et est appelez".split())
LEADS = SALUTATIONS | TITLES
BEFORE_NAME = BEFORE_PERSON | LABELS | SALUTATIONS | GREETINGS
BEFORE_THING = set("der die das den dem des ein eine einen einem einer im am zum zur ins beim laut in aus nach the a of at in into la le les un une du des au".split())


@memo
def _patterns() -> dict[str, re.Pattern]:
    up = "A-Z" + "".join(chr(c) for c in range(0xC0, 0x530) if chr(c).isupper())
    word = rf"[{up}][\w’'\u0300-\u036f-]*"
    any_word = r"[^\W\d_][\w’'\u0300-\u036f-]*"
    number = r"\d{1,4}(?:[ ]?[a-zA-Z](?![\w.]))?(?:[ ]?[-–/][ ]?\d{1,4}(?:[ ]?[a-z](?![\w.]))?)?"
    town = rf"(?:D[- ]{{0,2}})?\d{{5}}[ ]+{word}(?:[ ](?:am|an der|bei|im|ob der)[ ]{word})?"
    street = rf"(?:(?:Am|An der|An den|Im|In der|Zum|Zur)[ ])?(?:{word}(?<=[\w’'])(?i:{STREET_TYPES})|{word}[ -](?i:{STREET_TYPES}))"
    english = r"(?:Street|Road|Avenue|Lane|Drive|Square|Court|Close|Boulevard|Terrace|Crescent|Gardens|Quay|St\.?|Rd\.?|Ave\.?|Blvd\.?|Ln\.?)"
    uk, us = r"[A-Z]{1,2}\d[A-Z\d]? \d[A-Z]{2}", r"[A-Z]{2} \d{5}(?:-\d{4})?"
    french = r"(?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|cours|route)"
    joined = r"(?:,[ ]?|[ ]in[ ]|[ ]IN[ ]|[ ]à[ ]|[ ]|[ ]·[ ])"
    lower = r"[^\W\d_A-Z][\w’'\u0300-\u036f-]+"
    return {
        "email": re.compile(
            r"(?<![\w+%.-])[\w+%-]+(?:\.[\w+%-]+)*(?:\s?@\s?|\s?[(\[{]\s?(?:at|ät|@)\s?[)\]}]\s?)[\w-]+(?:(?:\.|\s?[(\[{]\s?(?:dot|punkt|\.)\s?[)\]}]\s?)[\w-]+)+"
            r"|(?<![\w+%.-])[\w+%-]+(?:\.[\w+%-]+)*[ ](?:at|AT)[ ][\w-]+(?:(?:[ ](?:dot|DOT|punkt)[ ]|\.)[\w-]+)*[ ](?:dot|DOT|punkt)[ ][\w-]+",
            re.I,
        ),
        "email_gate": re.compile(r"@|[(\[{]\s?[aäAÄ][tT]\s?[)\]}]|[ ](?:at|AT)[ ][^\n]*?[ ](?:dot|DOT|punkt)[ ]"),
        "iban": re.compile(r"(?<![\w])[A-Z]{2}\d{2}(?:[ ]?[0-9A-Z]{4}){2,7}(?:[ ]?[0-9A-Z]{1,4})?(?![\w])"),
        "tax": re.compile(r"(?<![\w-])\d{2}[ ]?\d{3}[ ]?\d{3}[ ]?\d{3}(?![\w-])|(?<![\w])\d{2,3}/\d{3}/\d{4,5}(?!\w)|(?<!\w)DE[ ]?\d{9}(?!\w)"),
        "social": re.compile(r"(?<![\w])\d{2}[ ]?\d{6}[ ]?[A-Z][ ]?\d{3}(?![\w])|(?<!\w)[12][ ]?\d{2}[ ]?\d{2}[ ]?\d{2}[ ]?\d{3}[ ]?\d{3}(?:[ ]?\d{2})?(?!\w)"),
        "ssn": re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])"),
        "nino": re.compile(r"(?<!\w)[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z][ ]?\d{2}[ ]?\d{2}[ ]?\d{2}[ ]?[A-D](?!\w)"),
        "dni": re.compile(r"(?<!\w)(?:\d{8}|[XYZ]\d{7})-?[A-Z](?!\w)"),
        "ahv": re.compile(r"(?<!\w)756[. ]?\d{4}[. ]?\d{4}[. ]?\d{2}(?!\w)"),
        "pass": re.compile(r"(?<![\w])(?=[A-Z0-9]*\d)[A-Z][A-Z0-9]{7,9}(?![\w])"),
        "card": re.compile(r"(?<![\w-])\d{4}(?:[ -]?\d{4}){2,3}(?:[ -]?\d{1,3})?(?![\w-])"),
        "phone": re.compile(r"(?<![\w/.,+-])(?:\+[1-9]\d{0,2}|00[1-9]\d{0,2}|\(\+?0\d{1,5}\)|0[1-9]\d{1,4})(?:[ ]?\(0?\d{0,4}\))?(?:[ /.-]{0,3}\d)+(?![\w])"),
        "local_phone": re.compile(r"(?<![\w/.,+-])(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"),
        "address": re.compile(rf"(?:(?:{town})(?:,[ ]?|[ ]))?(?<![\w-]){street}[ ]+(?:[Nn][Rr]\.?[ ]*)?{number}(?![\w])(?:{joined}{town})?"),
        "english": re.compile(rf"(?<![\w-])\d{{1,4}}[a-zA-Z]?[ ](?:{word}[ ]){{1,3}}{english}(?!\w)(?:,[ ]{word}(?:[ ]{word})?(?:,?[ ](?:{uk}|{us}))?|,?[ ](?:{uk}))?"),
        "french": re.compile(rf"(?<![\w-])\d{{1,4}}(?:[ ](?:bis|ter))?,?[ ]{french}[ ](?:(?:de la|de l['’]|du|des|de|d['’])[ ]?)?{word}(?:[ -]{word}){{0,3}}(?:,?[ ]\d{{5}}[ ]{word})?"),
        "token": re.compile(rf"(?<![\w@.’'-])(?:[{up}]\.(?:-?[{up}]\.)*(?!\w)|{word}(?![\w@])(?!\.\w))"),
        "particle": re.compile(rf"^ {PARTICLES} $"),
        "lead": re.compile(rf"(?<![\w-])(?:{PARTICLES}) $"),
        "org": re.compile(r"(?i)^[ ]*(?:&|(?:g?gmbh|ag|eg|e\.\s?v\.|ug|gbr|kg|mbh|haftungsbeschränkt|ltd|inc|sarl)(?!\w))"),
        "sign": re.compile(rf"\n+[- ]*((?:{any_word}\.?[ ]|{any_word}\.-?){{0,5}}{any_word}(?:,[ ]{any_word}(?:[ ]\w\.)?)?)(?=[ ]*(?:\n|$|·|\||\(|,|  ))"),
        "lower": re.compile(
            rf"(?:[:;,.!?(|\"\n=–·-][ ]*|  |^|(?<!\w)([^\W\d_]{{2,20}})[ ])(?=({lower})(?:([ ](?:\w\.[ ])*)|(,[ ]))({lower})((?:[ ]\w\.(?!\w))?))"
        ),
        "digit": re.compile(r"\d"),
        "digits": re.compile(r"\d(?:[ ./()-]{0,3}\d){5}"),
        "middle": re.compile(r"(?:[ ]\w\.)*"),
        "number_after": re.compile(r"[a-zßA-Z.][ ]+(?:[Nn][Rr]\.?[ ]*)?\d"),
        "street_end": re.compile(rf"{STREET_TYPES}$", re.I),
    }


# Words close before a span that support or deny its type.
SUPPORT = {
    "tax": r"steuer|\btax|\btin\b|idnr|fiscal|\bust|\bvat\b", "pass": r"ausweis|pass|passeport|identity|id card|perso\b|id no", "social": r"sozial|versicherung|sv-?n|social|insurance|sécu|insee",
    "iban": r"iban|konto|payment|account|honorar|überweis|bank|compte|virement", "phone": r"tel|fon|phone|mobil|fax|anruf|call|number|erreichbar|ruf|appel|cell|reach|sms|whatsapp|handy",
    "card": r"karte|card|carte|visa|master", "ssn": r"ssn|social|security|tax|tin\b|id\b", "nino": r"insurance|nino|\bni\b|national", "dni": r"dni|nie|nif|identity|ausweis|id\b", "ahv": r"ahv|avs|sozial|versicherung|social",
}
DENY = {
    "phone": r"(?:bestell(?:nummer|nr\.?)|order|ordner|isbn|ausschreibung|call|list|liste|aktenzeichen|az\.?|file|invoice no\.?|rechnung(?:snummer)?|nr\.)\s*$",
    "tax": r"(?:bestell(?:nummer|nr\.?)|order|ordner|isbn|aktenzeichen)\s*$", "card": r"(?:bestell|order|isbn)\w*\s*$", "ssn": r"(?:bestell|order|isbn|aktenzeichen|file)\w*\s*$",
}
#: Of a telephone with a country code these words deny nothing.
_CODED = re.compile(r"\+|00")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = re.sub(r"\s", "", iban).upper()
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def mod11_10(digits: str) -> bool:
    product = 10
    for c in digits[:-1]:
        total = (int(c) + product) % 10 or 10
        product = 2 * total % 11
    return (11 - product) % 10 == int(digits[-1])


def insee(digits: str) -> bool:
    """The two last of the 15 digits of a French social security number."""
    return len(digits) == 15 and 97 - int(digits[:13]) % 97 == int(digits[13:])


def mod23(number: str) -> bool:
    """The letter of a Spanish identity number."""
    s = re.sub(r"\W", "", number)
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(s[:-1].replace("X", "0").replace("Y", "1").replace("Z", "2")) % 23] == s[-1]


def ean13(digits: str) -> bool:
    return len(digits) == 13 and sum(int(c) * (1 + 2 * (i % 2)) for i, c in enumerate(digits)) % 10 == 0


def _near(text: str, start: int, kind: str) -> float:
    """Adjustment by the words up to 40 characters before a span."""
    before = text[max(0, start - 40) : start].lower()
    score = 0.0
    if kind in SUPPORT and re.search(SUPPORT[kind], before):
        score += 0.4
    if kind in DENY and re.search(DENY[kind], before):
        score -= 0.6
    return score


def _numbers(text: str) -> list[tuple[int, int, str, float]]:
    p, out = _patterns(), []

    def each(key: str, kind: str, score) -> None:  # noqa: ANN001
        for m in p[key].finditer(text):
            digits = re.sub(r"\D", "", m[0])
            out.append((m.start(), m.end(), kind, score(m[0], digits) + _near(text, m.start(), key)))

    each("pass", "id_number", lambda *_: 0.15)
    each("dni", "id_number", lambda s, _: 0.1 + 0.3 * mod23(s))
    if not p["digits"].search(text):  # all others hold six digits or more
        return out
    each("iban", "id_number", lambda s, _: 0.3 + 0.3 * (not s.startswith("DE") or len(re.sub(r"\s", "", s)) == 22) + 0.3 * mod97(s) if sum(c.isdigit() for c in s) >= 10 else 0.0)
    each("tax", "id_number", lambda _, d: 0.15 + 0.2 * (len(d) == 11 and mod11_10(d)))
    each("social", "id_number", lambda s, d: 0.55 if any(c.isalpha() for c in s) else 0.1 + 0.5 * insee(d))
    each("ssn", "id_number", lambda *_: 0.3)
    each("nino", "id_number", lambda *_: 0.35)
    each("ahv", "id_number", lambda _, d: 0.2 + 0.4 * ean13(d))
    each("card", "id_number", lambda _, d: 0.1 + 0.2 * luhn(d))
    for m in p["phone"].finditer(text):
        digits = len(re.sub(r"\D", "", m[0]))
        shape = 0.6 if 8 <= digits <= 15 else 0.0
        if re.fullmatch(r"\d{4}-\d{3}-\d{2}|\d{2}[./-]\d{2}[./-]\d{2,4}", m[0]):
            shape = 0.1
        near = _near(text, m.start(), "phone")
        out.append((m.start(), m.end(), "phone", shape + (0.0 if shape > 0.5 and near < 0 and _CODED.match(m[0]) else min(0.2, near))))
    for m in p["local_phone"].finditer(text):
        out.append((m.start(), m.end(), "phone", 0.2 + _near(text, m.start(), "phone")))
    return out


def _plain(text: str) -> str:
    s = text.lower()
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("ø", "oe"), ("ł", "l")):
        s = s.replace(a, b)
    return s if s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def _key(word: str) -> str:
    return word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()


def order_before(text: str, start: int) -> bool:
    """``i. A.`` or ``i. V.`` ("by order") stands before."""
    return bool(re.search(r"(?<!\w)[iI]\.[ ]?[AV]\.[ ]$", text[max(0, start - 8) : start]))


class _Names:
    """Candidates of one text: (start, end, first, last, base, lone), and the evidence of their words."""

    def __init__(self, text: str, mails: list[str]) -> None:
        self.text, self.p = text, _patterns()
        self.found: dict[tuple[int, int], tuple[str | None, str | None, float, bool]] = {}
        self.words: dict[tuple[str, str], bool] = {}
        self.told: set[int] = set()
        self.locals = {t for m in mails for t in re.split(r"[._+%-]+", _plain(re.split(r"\s?[@(\[{]|[ ]at[ ]", m, maxsplit=1)[0])) if len(t) > 1}

    def add(self, start: int, end: int, first: str | None, last: str | None, base: float, strong: bool, lone: bool = False) -> None:
        f, g = first and _key(first), last and _key(last)
        if (f in NO_NAME) or (g in NO_NAME):
            return
        if not strong and self.locals and f and g and not lone:
            a, b = _plain(f), _plain(g)
            strong = (a in self.locals and b in self.locals) or a[:1] + b in self.locals or a + b in self.locals or b + a[:1] in self.locals
        base += 4.0 * strong
        old = self.found.get((start, end))
        if old is None or old[2] < base:
            self.found[start, end] = (f, g, base, lone)
        for word, role in ((f, "first"), (g, "last")):
            if word and len(word) > 1:
                self.words[word, role] = self.words.get((word, role), False) or strong

    def around(self, start: int, end: int) -> float:
        """What the words before and after say."""
        text, score = self.text, 0.0
        before = text[max(0, start - 24) : start].rstrip(" ")
        if before and before[-1] not in ",;\n":
            word = before[max(before.rfind(" "), before.rfind("\n")) + 1 :].lower()
            if word.endswith(":"):
                score += 2.0 if word[:-1] in LABELS else 0.5
            else:
                word = word.rstrip(".")
                score += 0.7 * (word in BEFORE_PERSON) - 1.5 * (word in BEFORE_THING) + 1.0 * (word in LABELS)
        if text[end : end + 1] == " ":
            after = text[end + 1 : end + 18]
            if after[:1].isdigit():
                score -= 1.5
            elif after.split(" ", 1)[0].rstrip(".,;") in PERSON_VERBS:
                score += 1.0
            elif after[:1] in "&gGaAeEuUkKmMhHlLiIsS" and self.p["org"].match(after):
                score -= 6.0
        elif text[end : end + 2] == ", " and text[end + 2 : end + 3] in "gGaAeEuUkK" and self.p["org"].match(text[end + 2 : end + 18]):
            score -= 6.0
        return score

    def run(self, toks: list[tuple[int, int, str]]) -> None:
        """Candidates of words that stand together."""
        text = self.text
        leads = [_key(w).rstrip(".") in LEADS or (w in ("A.", "V.") and bool(re.search(r"(?<!\w)[iI]\.[ ]?$", text[max(0, s - 3) : s]))) for s, _, w in toks]
        cut = next((i for i in range(1, len(toks)) if leads[i] and not leads[i - 1]), 0)
        if cut:
            self.run(toks[:cut])
            self.run(toks[cut:])
            return
        k = sum(leads)
        strong, greeting = k > 0, False
        if not strong:
            at = max((i for i, t in enumerate(toks[:-1]) if _key(t[2]) in GREETINGS), default=-1)
            greeting, k = at >= 0, at + 1
        toks = toks[k:]
        if not toks:
            return
        forms = [i for i, t in enumerate(toks) if t[2].lower() in ORG_FORMS]
        firm = forms[-1] if forms else -1
        end_of_run = toks[-1][1]
        shouted = len(toks) > 2 and all(t[2].isupper() for t in toks)
        for i, (s, e, w) in enumerate(toks):
            start = s
            if i == 0 and strong:
                lead = self.p["lead"].search(text[max(0, s - 12) : s])
                start = s - (len(lead[0]) if lead else 0)
            initial = w.endswith(".")
            j = i + 1
            while j < len(toks) and toks[j][2].endswith("."):
                j += 1
            outside = (-6.0 if firm - 4 < i <= firm else -2.0 if i <= firm else 0.0) - (3.0 if shouted else 0.0)
            for last in (j, j + 1):
                if last >= len(toks) or toks[last][2].endswith(".") or (last > j and initial):
                    continue
                end = toks[last][1]
                base = outside + self.around(start, end) - 1.2 * (last > j)
                pair_strong = (strong and i == 0) or (greeting and i == 0 and text[end : end + 1] in ",!\n" and end == end_of_run)
                self.add(start, end, None if initial else w, toks[last][2], base + INITIAL * initial, pair_strong and not outside)
            if len(toks) == 1 or (i == 0 and strong):
                if initial:
                    continue
                if strong:
                    self.add(start, e, None, w, outside, not outside and len(toks) == 1, lone=True)
                    self.told.add(start)
                elif greeting:
                    self.add(s, e, w, None, 0.0, text[e : e + 1] in ",!\n", lone=True)

    def find(self) -> None:
        text, p = self.text, self.p
        run: list[tuple[int, int, str]] = []
        singles: list[tuple[int, int, str]] = []
        for m in p["token"].finditer(text):
            s, e, w = m.start(), m.end(), m[0]
            if run:
                gap = text[run[-1][1] : s]
                low = run[-1][2].lower().rstrip(".")
                single = len(w) == 1 or len(run[-1][2]) == 1
                if single or gap != " " and not (gap in (". ", ".-", ". -", "-") and (low in TITLES or low in SALUTATIONS)) and not (gap == "" and run[-1][2].endswith(".")) and not (len(gap) < 12 and p["particle"].match(gap)):
                    self.close(run, singles)
                    run = []
                elif not w.isalpha() and p["digit"].search(w):
                    self.close(run, singles)
                    run = []
            if not w.isalpha() and ("_" in w or p["digit"].search(w)):
                continue
            run.append((s, e, w))
        self.close(run, singles)
        self.turned(singles)
        at = text.find("\n")
        while at >= 0:
            ending = text[max(0, at - 24) : at].rstrip(",.! ")
            if ending and _key(ending[max(ending.rfind(" "), ending.rfind("\n")) + 1 :]) in CLOSINGS:
                m = p["sign"].match(text, at)
                if m:
                    self.signature(m)
            after = at + 1
            while text[after : after + 1] == "\n":
                after += 1
            at = text.find("\n", after)
        for m in p["lower"].finditer(text):
            if m[1] and m[1].lower() not in BEFORE_NAME:
                continue
            a, b, s = m[2], m[5], m.start(2)
            if m[4]:
                self.add(s, m.end(6), b, a, -2.5 + self.around(s, m.end(6)), False)
            elif a.islower() and b.islower():
                self.add(s, m.end(5), a, b, -1.5 + self.around(s, m.end(5)), order_before(text, s))

    def close(self, run: list[tuple[int, int, str]], singles: list[tuple[int, int, str]]) -> None:
        if not run:
            return
        if len(run) > 1:
            self.run(run)
        else:
            s, e, w = run[0]
            lead = self.p["lead"].search(self.text[max(0, s - 12) : s])
            if lead:  # "Frau von der Heide" and "Herrn de Vries" are one run with their particles; alone a particle says little
                s -= len(lead[0])
            base = self.around(s, e)
            if base > 0.6 and len(w) > 1 and not w.endswith("."):
                self.add(s, e, w, w, base - 1.0, False, lone=True)
        singles.append(run[0])
        if len(run) > 1:
            singles.append(run[-1])

    def turned(self, singles: list[tuple[int, int, str]]) -> None:
        """Last, First [M.] between delimiters, and single items of lists."""
        text = self.text
        for (s, e, w), (s2, e2, w2) in zip(singles, singles[1:], strict=False):
            if text[e:s2] == ", " and len(w) > 1 < len(w2) and w[-1] != "." != w2[-1]:
                end = self.p["middle"].match(text, e2).end()
                after = text[end : end + 2]
                ends = not after or after[:1] in ";\n)|\"" or after[:2] in ("  ", ". ", ".\n") or after == "." or after[1:].islower()
                before = text[max(0, s - 2) : s]
                starts = not before or before[-1:] in "\n(\"|=" or before in (": ", "; ", ". ", "  ", "- ", "* ")
                self.add(s, end, w2, w, -1.5 + 0.7 * ends + 0.7 * starts + self.around(s, end), s in self.told)
        for s, e, w in singles:
            if w[-1] != "." and text[max(0, s - 2) : s] in (": ", "; ") and text[e : e + 1] in ";\n":
                self.add(s, e, w, w, -0.3, False, lone=True)

    def signature(self, m: re.Match) -> None:
        parts = list(re.finditer(r"[^\s,.-]+(?:-[^\s,.-]+)*\.?", m[1]))
        order = re.match(r"i\.[ ]?[av]\.", m[1], re.I)  # "by order"
        skip = 2 if order else 0
        while skip < len(parts) - 1 and parts[skip][0].lower().rstrip(".") in SALUTATIONS | TITLES:
            skip += 1
        parts = parts[skip:]
        if not parts or len(parts) > 4 or any(_key(w[0]) in NO_NAME | GREETINGS for w in parts) or self.p["org"].match(self.text[m.end() : m.end() + 20]):
            return
        words = [w[0] for w in parts if not w[0].endswith(".")]
        s, end = m.start(1) + parts[0].start(), m.end(1)
        shape = len(words) <= 2 and all(len(w) > 1 for w in words)
        if len(words) == 1 and len(parts) == 1:
            self.add(s, end, words[0], words[0], -0.5, words[0][0].isupper(), lone=True)
        elif "," in m[1] and len(words) > 1:
            self.add(s, end, words[1], words[0], 0.0, shape)
        elif words and not parts[-1][0].endswith("."):
            self.add(s, end, words[0] if len(words) > 1 else None, words[-1], INITIAL * (len(words) == 1), shape)


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str | None, str | None, float, bool]], list[tuple[str, str, bool]]]:
    """(spans that are certain, candidates for names, evidence of their words) of a text."""
    if not text or not text.strip():
        return [], [], []
    p = _patterns()
    spans: list[tuple[int, int, str, float]] = []
    mails: list[str] = []
    if p["email_gate"].search(text):
        for m in p["email"].finditer(text):
            spans.append((m.start(), m.end(), "email", 0.9))
            mails.append(m[0])
    if p["digit"].search(text):
        spans += _numbers(text)
        german = any(p["street_end"].search(text, max(0, m.start() - 11), m.start() + 1) for m in p["number_after"].finditer(text))
        for key in ("address", "english", "french") if german else ("english", "french"):
            spans += [(m.start(), m.end(), "address", 0.7) for m in p[key].finditer(text)]
    names = _Names(text, mails)
    names.find()
    sure = apart([(s, e, k, 0.0) for s, e, k, score in spans if score >= THRESHOLD])
    return sure, [(s, e, *c) for (s, e), c in names.found.items()], [(w, r, ok) for (w, r), ok in names.words.items()]


def odds(n: int, strong: int) -> float:
    """Log odds of a word that stands in ``n`` documents in a place of a name, in ``strong`` of them with evidence."""
    return math.log((strong + 0.5) / (n - strong + 1.0))


def apart(spans: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str]]:
    """Spans that don't overlap, in order: by type, then by score, then the longer. Kept spans stay sorted, so each is placed by
    binary search."""
    starts: list[int] = []
    kept: list[tuple[int, int, str]] = []
    for start, end, kind, _ in sorted(spans, key=lambda s: (TYPES.index(s[2]), -s[3], s[0] - s[1], s[0])):
        i = bisect_right(starts, start)
        if (i and kept[i - 1][1] > start) or (i < len(kept) and kept[i][0] < end):
            continue
        at = bisect_left(starts, start)
        starts.insert(at, start)
        kept.insert(at, (start, end, kind))
    return kept


def score(base: float, lone: bool, first: float | None, last: float | None) -> float:
    """Score of a candidate: above 0 it is a name. ``first`` and ``last`` are the log odds of its words, None where it has none."""
    if lone:
        return base + max(x for x in (first, last, -9.0) if x is not None) - LONE
    return base + (first or 0.0) + (last or 0.0) - PAIR


def find_all(texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
    """The spans of each text of a corpus on one machine: what ``spans`` gives, for tests and small inputs."""
    scans = [scan(t) for t in texts]
    seen: dict[tuple[str, str], list[int]] = {}
    for _, _, words in scans:
        for w, r, ok in words:
            x = seen.setdefault((w, r), [0, 0])
            x[0] += 1
            x[1] += ok
    get = lambda w, r: odds(*seen.get((w, r), (0, 0))) if w else None
    out = []
    for sure, names, _ in scans:
        scored = [(s, e, "name", score(base, lone, get(f, "first"), get(g, "last"))) for s, e, f, g, base, lone in names]
        out.append(apart([(s, e, k, 0.0) for s, e, k in sure] + [x for x in scored if x[3] > 0]))
    return out


def find(text: str | None) -> list[tuple[int, int, str]]:
    """Spans of a text that stands alone."""
    return find_all([text])[0]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_TEXT, _INT, _REAL, _FLAG = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_SCANNED = _struct(
    sure=T.ArrayType(_struct(start=_INT, end=_INT, kind=_TEXT, piece=_TEXT)),
    names=T.ArrayType(_struct(start=_INT, end=_INT, first=_TEXT, last=_TEXT, base=_REAL, lone=_FLAG, piece=_TEXT)),
    words=T.ArrayType(_struct(word=_TEXT, role=_TEXT, strong=_FLAG)),
)


@F.pandas_udf(_SCANNED)
def _scan_all(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        sure, names, words = scan(t)
        rows.append(([(s, e, k, t[s:e]) for s, e, k in sure], [(*n, t[n[0] : n[1]]) for n in names], words))
    return pd.DataFrame(rows, columns=["sure", "names", "words"])


@F.pandas_udf(T.ArrayType(_struct(start=_INT, end=_INT, kind=_TEXT, piece=_TEXT)))
def _apart_all(spans: pd.Series) -> pd.Series:
    def one(listed) -> list:  # noqa: ANN001
        pieces_ = {(x["start"], x["end"]): x["piece"] for x in listed}
        return [(s, e, k, pieces_[s, e]) for s, e, k in apart([(x["start"], x["end"], x["kind"], x["score"]) for x in listed])]

    return spans.map(one)


def spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_row, key, found) of the documents that hold something: ``found`` is an array of (start, end, kind, piece) that don't
    overlap, in order. ``_row`` numbers the rows of ``docs``, so that repeated or null keys stay apart.

    Candidates are kept with their row; their words meet the counts by two joins on the word, whose few frequent words the
    engine splits; only candidates that are names come back to their document.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), _scan_all(F.coalesce(F.col(text), F.lit(""))).alias("s"))
    rows = checkpointed(numbered.select("_row", "_key", "s.*").where((F.size("sure") > 0) | (F.size("names") > 0)))
    seen = rows.select(F.explode("words").alias("w")).groupBy("w.word", "w.role").agg(F.count(F.lit(1)).alias("n"), F.count_if("w.strong").alias("k"))
    lexicon = checkpointed(seen.select("word", "role", F.log((F.col("k") + 0.5) / (F.col("n") - F.col("k") + 1.0)).alias("odds")))
    names = rows.select("_row", "_key", F.explode("names").alias("c")).select("_row", "_key", "c.*")
    # A side without a word (an initial) must not gather in one partition: its key is the row.
    names = names.withColumns({x: F.coalesce(x, F.concat(F.lit("\x00"), F.col("_row").cast("string"))) for x in ("first", "last")})
    for role in ("first", "last"):
        names = names.join(lexicon.where(F.col("role") == role).select(F.col("word").alias(role), F.col("odds").alias(f"_{role}")), role, "left")
    least = F.lit(-9.0)
    lone = F.col("base") + F.greatest("_first", "_last", least) - LONE
    pair = F.col("base") + F.coalesce("_first", F.lit(0.0)) + F.coalesce("_last", F.lit(0.0)) - PAIR
    named = names.withColumn("score", F.when(F.col("lone"), lone).otherwise(pair)).where("score > 0")
    sure = rows.select("_row", "_key", F.explode("sure").alias("x")).select("_row", "_key", F.struct("x.start", "x.end", "x.kind", F.lit(0.0).alias("score"), "x.piece").alias("x"))
    both = sure.unionByName(named.select("_row", "_key", F.struct("start", "end", F.lit("name").alias("kind"), "score", "piece").alias("x")))
    listed = both.groupBy("_row").agg(F.first("_key").alias(key), F.array_sort(F.collect_list("x")).alias("x"))
    return listed.select("_row", key, _apart_all("x").alias("found"))


def pieces(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pii_type, found_text): each distinct piece of each document."""
    once = F.array_distinct(F.transform("found", lambda x: F.struct(x["kind"].alias("pii_type"), x["piece"].alias("found_text"))))
    return spans(docs, key, text).select(key, F.explode(once).alias("x")).select(key, "x.pii_type", "x.found_text")


@F.pandas_udf(_TEXT)
def _redacted(texts: pd.Series, found: pd.Series) -> pd.Series:
    def one(t: str | None, listed) -> str | None:  # noqa: ANN001
        if t is None or listed is None:
            return t
        out, at = [], 0
        for x in listed:
            out += [t[at : x["start"]], f"[{x['kind'].upper()}]"]
            at = x["end"]
        return "".join([*out, t[at:]])

    return pd.Series([one(t, x) for t, x in zip(texts, found, strict=True)])


def redact(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): the texts with [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] and [NAME] in place of what was found; null stays
    null. The rows are checkpointed once with their numbers, and only spans meet the texts."""
    rows = checkpointed(docs.select(F.monotonically_increasing_id().alias("_at"), F.col(key).alias("_id"), F.col(text).alias("_t")))
    found = spans(rows, "_at", "_t").select("_at", "found")
    return rows.join(found, "_at", "left").select(F.col("_id").alias(key), _redacted("_t", "found").alias(text))
