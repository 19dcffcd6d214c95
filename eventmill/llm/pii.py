"""Personal data replaced by surrogates: keyed, of the same type and format, distinct, and the same for every mention.

Mentions are found in each text; equal entities (by type and canonical value) are counted as one across all documents.
Every distinct entity draws a surrogate from a keyed hash of its value. Entities whose draws meet each other, or meet
a value that really occurs, draw again until all differ. The mentions are then rewritten in their own format.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import cut, unused

KEY = "surrogates-1"
#: Draws an entity may need; reached only if a format has no free value left.
ROUNDS = 240

#: Given names by script and gender; surrogates come from the list that the original fits.
GIVEN = {
    ("latin", "f"): "Anna Maria Emma Sophie Laura Julia Clara Elena Sarah Alice Nora Eva Lucy Martha Helen Ruth Irene Diana Paula Olivia".split(),
    ("latin", "m"): "John Peter Paul Thomas David Martin Daniel James Robert Michael Simon Oscar Felix Victor Henry George Walter Albert Hugo Leon".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Андрей Михаил Николай Павел Виктор".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Γιάννης Νίκος Χρήστος Παναγιώτης Βασίλης".split(),
}
#: Forms of address and the gender they tell ('' for none).
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mademoiselle": "f",
    "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
#: Syllables that family names are put together from, by script.
SYLLABLES = {
    "latin": "ba del kor man ves ti ro lin gar mo sen ta hal be nor vi du ran ke lo".split(),
    "cyrillic": "ба вел кор ма нес ти ро лин гар мо сен та хал бе нор ви ду ран ке ло".split(),
    "greek": "βα δελ κορ μα νεσ τι ρο λιν γαρ μο σεν τα χαλ βε νορ βι δου ραν κε λο".split(),
}
_GENDER = {name: g for (_, g), names in GIVEN.items() for name in names}
#: Given names that tell no gender, for persons whose gender neither the title nor a given name tells.
NEUTRAL = {
    "latin": "Alex Robin Kim Sam Chris Noel Sascha Jordan Taylor Morgan Casey Jamie".split(),
    "cyrillic": "Саша Женя Валя Слава Шура Паша".split(),
    "greek": "Άλεξ Σαμ Κρις Τζο Ρόμπιν Νοέλ".split(),
}
#: Words in lower case that may stand between the parts of a name.
PARTICLES = "van von der den de del della dela di da do dos das du des la le el al bin ibn ben ter ten zu zur y".split()

# A part of a name starts with a capital and runs over hyphens and apostrophes (not a genitive's); an initial has a dot.
_FIRST = r"[^\W\d_a-zß-öø-ÿа-яёα-ωά-ώ]"
_MORE = r"(?:['’](?!s\b)[^\W\d_]+|-[^\W\d_]+)*"
_WORD = _FIRST + r"(?:[^\W\d_]+" + _MORE + r"|['’](?!s\b)[^\W\d_]+" + _MORE + ")"
_BETWEEN = r"[ ](?:(?:" + "|".join(PARTICLES) + r")[ ]){0,3}"
_NAME = (r"(?:(?:" + "|".join(PARTICLES) + r")[ ]){0,3}(?:" + _WORD + "|" + _FIRST + r"\.?(?=[ ](?:" + _FIRST + r"\.[ ])*" + _WORD + "))"
         r"(?:" + _BETWEEN + "(?:" + _WORD + "|" + _FIRST + r"\.(?=[ ](?:" + _FIRST + r"\.[ ])*" + _WORD + "))){0,5}")
#: One alternative per type, tried from left to right at each place of a text that no letter or digit precedes.
MENTION = re.compile(r"""(?<!\w)(?=[\w+(:.-])(?:
    (?P<secret>\b(?i:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|auth[_-]?token|token)\b["']?\s{0,3}[=:]\s{0,3}["']?(?P<value>(?=[^\s"']*\d)[A-Za-z0-9+/_\-.~!@$%^&*]{6,}=*))
  | (?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}(?![\w]))
  | (?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?(?!\w))
  | (?P<card>(?<![\w.+-])[3-6]\d{3}(?:(?P<cs>[ -]?)\d{4})(?:(?P=cs)\d{4})(?:(?P=cs)\d{1,7})(?![\w])
      |(?<![\w.+-])3[47]\d{2}(?P<amex>[ -])\d{6}(?P=amex)\d{5}(?![\w])
      |(?<![\w.+-])2[2-7]\d{2}(?P<two>[ -]?)\d{4}(?P=two)\d{4}(?P=two)\d{4}(?![\w]))
  | (?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))
  | (?P<ipv6>(?<![\w:])(?=:*[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\w:]|\.\d)
      |(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}(?::?[0-9A-Fa-f]{1,4}){1,4}(?![\w:]))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])|(?<![\w-])(?<!\d[ ])(?!000|666|9)\d{3}[ ](?!00)\d{2}[ ](?!0000)\d{4}(?![\w-]|[ ]\d))
  | (?P<phone>(?<![\w.+(-])(?:\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{1,4}){2,5}|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4}
      |(?<!\d[ ])0[1-9]\d{1,3}(?:[ /-]\d{5,8}|[ -]\d{3,4}[ -]\d{4})(?![ ]\d))(?![\w-]))
  | (?P<person>\b(?P<title>""" + "|".join(sorted(TITLES, key=len, reverse=True)) + r""")\.?[ ](?P<name>""" + _NAME + r"""))
)""", re.VERBOSE)
#: What a text must hold to have any mention; run as a filter before the search proper, by Spark's own expressions. Words are
#: looked for only where no ASCII letter or digit precedes, which any engine's idea of a word's beginning allows.
MAY_HAVE = (r"@|[0-9](?:[0-9]{2}|\.[0-9])|\+[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]|::[0-9A-Fa-f]|(?<![0-9A-Za-z_])(?:"
            r"(?i:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|auth[_-]?token|token)|(?:" + "|".join(TITLES) + r")\.? )")


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    kind: str
    canonical: str


def luhn_ok(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def script_of(text: str) -> str:
    return "cyrillic" if re.search(r"[Ѐ-ӿ]", text) else "greek" if re.search(r"[Ͱ-Ͽ]", text) else "latin"


def mentions(text: str | None) -> list[Mention]:
    """Mentions in order, without overlaps. Canonical values drop what format adds: spaces, dashes, case of addresses."""
    out = []
    for m in MENTION.finditer(text or ""):
        kind = "secret" if m["secret"] else "person" if m["person"] else m.lastgroup
        for name in ("email", "iban", "card", "ipv4", "ipv6", "ssn", "phone"):
            kind = name if m[name] else kind
        start, end = m.span("value" if kind == "secret" else "name" if kind == "person" else kind)
        raw = text[start:end]
        if kind in ("email", "ipv6"):
            canonical = raw.lower()
        elif kind in ("card", "phone", "ssn"):
            canonical = re.sub(r"\D", "", raw)
            if kind == "card" and not 13 <= len(canonical) <= 19 or kind == "phone" and not 7 <= len(canonical) <= 15:
                continue
            if kind == "card" and (m["amex"] or canonical[0] == "2") and not (luhn_ok(canonical) and ("2221" <= canonical[:4] <= "2720" or m["amex"])):
                continue
            if kind == "phone" and len(canonical) == 11 and raw.startswith("+1"):
                canonical = canonical[1:]
        elif kind == "iban":
            canonical = raw.replace(" ", "")
            if not 15 <= len(canonical) <= 34:
                continue
        elif kind == "person":
            name = raw.title() if raw.isupper() else raw
            known = [_GENDER[part] for word in name.split(" ") for part in re.split(r"['’-]", word) if part in _GENDER]
            canonical = f"{TITLES[m['title']] or (known[0] if known else 'n')} {name}"
        else:
            canonical = raw
        out.append(Mention(start, end, kind, canonical))
    return out


def _draw(key: str, kind: str, canonical: str, attempt: int):
    """An endless stream of numbers from a keyed hash of the entity and the attempt."""
    seed, block = f"{kind}|{attempt}|{canonical}".encode(), 0
    while True:
        yield from hmac.new(key.encode(), seed + b"|%d" % block, hashlib.sha256).digest()
        block += 1


def _same_shape(text: str, draw, keep: str = "") -> str:
    """Letters become letters of the same case and digits digits; a hex text stays hex; all else stays."""
    hexes = bool(re.fullmatch(r"[0-9a-f]{8,}|[0-9A-F]{8,}", text)) and bool(re.search(r"\d", text)) and bool(re.search(r"[a-fA-F]", text))
    out = []
    for c in text:
        if c in keep or not c.isalnum():
            out.append(c)
        elif hexes:
            out.append("0123456789abcdef"[next(draw) % 16] if text.lower() == text else "0123456789ABCDEF"[next(draw) % 16])
        elif c.isdigit():
            out.append(str(next(draw) % 10))
        else:
            script = script_of(c)
            letters = {"cyrillic": "абвгдежзиклмнопрстуф", "greek": "αβγδεζηθικλμνξοπρστ", "latin": "abcdefghijklmnopqrstuvwxyz"}[script]
            d = letters[next(draw) % len(letters)]
            out.append(d.upper() if c.isupper() else d)
    return "".join(out)


def surrogate(kind: str, canonical: str, key: str, attempt: int) -> str:
    """The entity's stand-in, in canonical form: its type, length, script, gender and check digits are kept.

    From the twelfth attempt on, a format too narrow for all its entities gets one more character per twelve attempts,
    and a private IPv4 address moves to 10.0.0.0/8.
    """
    draw = _draw(key, kind, canonical, attempt)
    longer = attempt // 12
    if kind == "email":
        local, _, domain = canonical.partition("@")
        labels = domain.split(".")
        named = [_same_shape(label, _draw(key, "domain", ".".join(labels[i:]), 0)) for i, label in enumerate(labels[:-1])]
        return _same_shape(local + "a" * longer, draw) + "@" + ".".join([*named, labels[-1]])
    if kind in ("card", "ssn", "phone"):
        brand = 4 if canonical[0] == "2" else 2 if len(canonical) == 15 and canonical[:2] in ("34", "37") else 1
        fixed = {"card": brand, "ssn": 0, "phone": max(canonical[0] == "0", len(canonical) - 10)}[kind]
        digits = [int(c) if i < fixed else next(draw) % 10 for i, c in enumerate(canonical)]
        if kind != "card" and digits[fixed] == 0 and canonical[fixed] != "0":
            digits[fixed] = 1 + next(draw) % 9
        if kind == "card" and luhn_ok(canonical):
            digits[-1] = next(d for d in range(10) if luhn_ok("".join(map(str, digits[:-1])) + str(d)))
        return "".join(map(str, digits + [next(draw) % 10 for _ in range(longer if kind == "phone" else 0)]))
    if kind == "iban":
        body = _same_shape(canonical[4:], draw)
        number = "".join(str(int(c, 36)) for c in body + canonical[:2] + "00")
        return f"{canonical[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "ipv4":
        parts = [int(p) for p in canonical.split(".")]
        private = 1 if parts[0] in (10, 127) else 2 if parts[:2] == [192, 168] or parts[0] == 172 and 16 <= parts[1] < 32 else 0
        if private == 2 and longer:
            parts, private = [10, *parts[1:]], 1
        new = [p if i < private else 1 + (next(draw) * 256 + next(draw)) % (222 if i == 0 else 254) for i, p in enumerate(parts)]
        while not private and new[0] in (10, 127, 172, 192):
            new[0] = 1 + next(draw) % 222
        return ".".join(map(str, new))
    if kind == "ipv6":
        # short compressed forms: groups grow to four digits, then groups are added in place of zeros
        more = max(0, min(longer - 3, 6 - len(re.findall(r"[0-9a-f]+", canonical)))) if "::" in canonical else 0
        wide = lambda text: min(4, len(text) + longer) if "::" in canonical else len(text)
        new = re.sub(r"[0-9a-f]+", lambda m: "".join("123456789abcdef"[next(draw) % 15] for _ in range(wide(m[0]))), canonical)
        for _ in range(more):
            new += ("" if new.endswith("::") else ":") + "".join("123456789abcdef"[next(draw) % 15] for _ in range(4))
        return new
    if kind == "person":
        gender, name = canonical[:1], canonical[2:]
        script, words = script_of(name), name.split(" ")
        given = NEUTRAL[script] if gender == "n" else GIVEN[(script, gender)]

        def family(part: str) -> str:
            by_family = _draw(key, "family", part, attempt)
            return "".join(SYLLABLES[script][next(by_family) % 20] for _ in range(3 + attempt // 2)).capitalize()

        def stand_in(word: str, first: bool) -> str:
            if word in PARTICLES:
                return word
            if len(word.rstrip(".")) == 1:
                return SYLLABLES[script][next(draw) % 20][0].upper() + word[1:]
            if first or word in _GENDER:
                at = next(draw) % len(given)
                return given[at] if given[at] != word else given[at - 1]
            # a short part before an apostrophe (O', D') stays, every other part is a family name of its own
            return "".join(part if i % 2 or not part or len(part) == 1 and i + 1 < len(parts) else family(part)
                           for parts in [re.split(r"(['’-])", word)] for i, part in enumerate(parts))
        if len(words) == 1 and name in _GENDER:
            first = stand_in(name, True)
            return first if attempt == 0 else first + family(name).lower()
        whole = [i for i, w in enumerate(words) if w not in PARTICLES]
        return " ".join(stand_in(w, i == whole[0] == 0 and len(whole) > 1) if i != whole[-1] else
                        (family(w) if w in _GENDER else stand_in(w, False)) for i, w in enumerate(words))
    return _same_shape(canonical + "a" * longer, draw)


def rendered(kind: str, raw: str, stand_in: str) -> str:
    """A surrogate in the format of one mention: its separators, and its case if all upper."""
    if kind in ("card", "phone", "ssn"):
        n = sum(c.isdigit() for c in raw)
        known = n - len(stand_in)
        digits = iter(re.sub(r"\D", "", raw)[:max(0, known)] + stand_in)
        return "".join(next(digits) if c.isdigit() else c for c in raw) + "".join(digits)
    if kind == "iban":
        letters = iter(stand_in)
        return "".join(c if c == " " else next(letters) for c in raw)
    if kind in ("email", "ipv6", "person") and raw.isupper():
        return stand_in.upper()
    return stand_in


def resolve(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, canonical, surrogate): distinct entities with distinct surrogates, none of them a value that occurs.

    Every round draws for the entities still open and joins the draws with the values that occur and the surrogates
    already given; of those that drew the same value the smallest keeps it. Rounds go on until none is open; after `rounds` of
    them an error names the types that have no value left. Each draw is a function of key, entity and attempt; rounds only compare equal values of one kind.
    """
    def drawn(attempt: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                yield rows.assign(surrogate=[surrogate(k, c, key, attempt) for k, c in zip(rows["kind"], rows["canonical"])])
        return run

    def bare(value: Column) -> Column:
        return F.when(F.col("kind") == "person", F.expr("substring(canonical, 3)")).otherwise(value)

    real = entities.select("kind", bare(F.col("canonical")).alias("surrogate")).distinct()
    left, given, rounds_given, attempt = entities, None, [], 0
    while True:
        draws = left.mapInPandas(drawn(attempt), "kind string, canonical string, surrogate string")
        taken = real if given is None else real.unionByName(given.select("kind", "surrogate"))
        free = draws.join(taken.distinct(), ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).select("kind", "canonical", "surrogate")
        rounds_given.append(cut(first))         # a round writes its own rows only
        if len(rounds_given) > 16:
            rounds_given = [cut(reduce(DataFrame.unionByName, rounds_given))]
        given = reduce(DataFrame.unionByName, rounds_given)
        left = cut(left.join(rounds_given[-1], ["kind", "canonical"], "left_anti"))
        attempt += 1
        if left.isEmpty():
            return given
        if attempt >= rounds:
            still = ", ".join(f"{r['kind']} ({r['count']}, as {r['canonical_length']} characters)" for r in left.groupBy("kind").agg(
                F.count(F.lit(1)).alias("count"), F.min(F.length("canonical")).alias("canonical_length")).orderBy("kind").collect())
            raise ValueError(f"no free surrogate after {rounds} draws for {still}")


def pseudonymise(docs: DataFrame, *, text_col: str = "text", key: str = KEY) -> DataFrame:
    """All rows and columns of docs with personal data in the text replaced, and two more: n_entities, kinds.

    n_entities counts the mentions replaced, kinds lists their types, sorted and joined by commas. Types: email, phone,
    card, iban, ipv4, ipv6, ssn, secret (the value after password, token and the like) and person (the whole name after one
    of the forms of address in TITLES: capitalised parts, initials, particles, hyphens and apostrophes; other names stay). Equal entities get equal surrogates in all documents, different ones different.

    Nulls: a null text stays null with no mentions; other columns are passed through whatever they hold (columns of the
    input called n_entities or kinds are replaced). Empty and very long texts are treated whole. Repeated rows are
    rewritten alike. Empty tables give no rows. Texts without any sign of a mention skip the joins; the others meet
    their replacements by a hash of the text, so copies are resolved once and ids may repeat or be null.
    """
    base = docs.drop("n_entities", "kinds")
    h, found = unused(base, "text_hash"), unused(base, "edits")
    sign = F.coalesce(F.col(text_col).rlike(MAY_HAVE), F.lit(False))
    plain = base.filter(~sign).withColumns({"n_entities": F.lit(0), "kinds": F.lit("")})
    marked = base.filter(sign)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            spans = [(key, m.start, m.end, m.kind, m.canonical, t[m.start:m.end]) for key, t in zip(rows["h"], rows["t"]) for m in mentions(t)]
            yield pd.DataFrame(spans, columns=["h", "start", "end", "kind", "canonical", "raw"])
    texts = marked.select(F.sha2(text_col, 256).alias("h"), F.col(text_col).alias("t"))
    spans = cut(texts.mapInPandas(find, "h string, start int, end int, kind string, canonical string, raw string").distinct())
    named = resolve(cut(spans.select("kind", "canonical").distinct()), key)

    @F.pandas_udf("string")
    def render(kind: pd.Series, raw: pd.Series, stand_in: pd.Series) -> pd.Series:
        return pd.Series([rendered(k, r, s) for k, r, s in zip(kind, raw, stand_in)], dtype=object)

    @F.pandas_udf("string")
    def rewrite(text: pd.Series, edits: pd.Series) -> pd.Series:
        return pd.Series([t if e is None else replaced(t, e) for t, e in zip(text, edits)], dtype=object)
    parts = spans.join(named, ["kind", "canonical"]).select("h", "start", "end", "kind", render("kind", "raw", "surrogate").alias("text"))
    edits = parts.groupBy(F.col("h").alias(h)).agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "text"))).alias(found))
    joined = marked.withColumn(h, F.sha2(text_col, 256)).join(edits, h, "left")
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col(f"{found}.kind"))), ",")
    done = joined.withColumns({
        text_col: rewrite(text_col, found), "n_entities": F.when(F.col(found).isNull(), 0).otherwise(F.size(found)), "kinds": F.coalesce(kinds, F.lit(""))})
    return done.select(*base.columns, "n_entities", "kinds").unionByName(plain)


def replaced(text: str, edits) -> str:
    """The text with each edit's stretch replaced; edits are in order and do not overlap."""
    pieces, at = [], 0
    for e in edits:
        pieces += [text[at:e["start"]], e["text"]]
        at = e["end"]
    return "".join(pieces) + text[at:]
