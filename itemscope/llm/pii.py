"""Surrogates for personal data.

Detected entities are replaced by keyed surrogates of the same type: an e-mail
address by an address of the same shape, digits by digits in the
same grouping (card numbers keep whether their check digit holds, IBANs stay
valid), addresses of the internet protocol by such addresses, names by names of the
same gender and script. The surrogate depends on the secret key and on the entity's
normal form, so one entity reads the same in all its formats and in all documents
(coreference); given names and family names are replaced part by part, so "Anna
Keller" and "Frau Keller" still name one family. Collision checks over the whole
corpus keep distinct entities distinct: a surrogate that another entity received, or
that is itself an entity of the corpus, is drawn again.

Plan: one pass finds mentions; distinct entities (a shuffle with map-side
distinct) draw surrogates, in rounds that only the collided enter again; mentions
meet their surrogates, are gathered per text, and a last pass rewrites the texts.
Texts stand for themselves by two hashes, so copies are worked on once. Nothing is
collected; sides measured to be small are broadcast, others shuffle.

Names are known by a title in front (in any case; every capitalised word after it, up to three, is a name) or by a
given name of the lists below. Not detected: names without a title whose given name is in no list,
names in small letters, postal addresses, dates of birth, telephone numbers in other groupings than
+country forms, (555) 123-4567, 555-123-4567, 555 123 4567, 01 23 45 67 89, 912 345 678 and 030 1234567.
A number with a country's code and the same number without it are one entity. A neutral title's given
name takes the gender it has elsewhere. Texts of any length are scanned whole, in time linear in their length. Where a corpus
fills a format (all 7-digit numbers, say), surrogates grow by a digit.

Defined results: null stays null; texts without entities are unchanged; of
overlapping mentions the one that starts first (the longer of two) is taken; repeated
rows get equal texts; empty tables work; other columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemscope.llm.common import join_measured, saved, text_key

#: Titles that announce a name, by gender; they are kept.
TITLES = {
    "m": "Mr Mister Sir Herr Herrn Monsieur Señor Sr Don Signor Господин г-н Κύριος".split(),
    "f": "Mrs Ms Miss Madam Frau Madame Mme Mlle Mademoiselle Señora Sra Doña Signora Госпожа г-жа Κυρία".split(),
    "n": "Dr Prof Professor Доктор".split(),
}
HAN_TITLES = {"m": ("先生",), "f": ("女士", "小姐")}
#: Given names by script and gender: known when met, and drawn as surrogates.
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Thomas Daniel Matthew Andrew Peter Paul Lukas Jonas Felix Stefan Martin Pierre Louis "
                    "Antoine Julien Carlos Miguel Javier Diego Pablo Marco Luca Henrik Oskar".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Emily Laura Julia Anna Lena Sophie Katharina Claire Camille "
                    "Juliette Margot Lucía Carmen Elena Isabel Paula Giulia Chiara Ingrid Astrid Clara".split(),
    ("cyrillic", "m"): "Иван Алексей Сергей Дмитрий Андрей Михаил Николай Павел Виктор Олег".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Дарья Вера".split(),
    ("greek", "m"): "Γιώργος Νίκος Κώστας Δημήτρης Γιάννης Πέτρος Στέφανος Ανδρέας".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Αγγελική Βασιλική Δήμητρα Ιωάννα".split(),
    ("han", "m"): "伟 强 磊 军 勇 杰 涛 明 超 刚".split(),
    ("han", "f"): "芳 娜 敏 静 丽 艳 娟 霞 玲 秀".split(),
}
#: Further given names that are known when met; surrogates do not draw them.
KNOWN_ONLY = {
    "m": "Adam Albert Alexander Alfred Anthony Arthur Benjamin Brian Charles Christian Christopher Claude Dennis Donald Edward Eric Frank Friedrich Gabriel "
         "George Gregory Hans Harold Henry Jack Jacob Jean Joseph Joshua Juan Jürgen Kenneth Kevin Klaus Larry Luis Manuel Mark Nicholas Patrick Philip "
         "Raymond Richard Ronald Ryan Samuel Scott Simon Stephen Steven Timothy Tobias Walter Wolfgang".split(),
    "f": "Alice Amanda Amy Andrea Angela Barbara Betty Brigitte Carol Caroline Catherine Charlotte Christine Cynthia Deborah Diana Donna Dorothy Emma Eva "
         "Franziska Helen Helga Isabella Jane Janet Johanna Katherine Kathleen Kimberly Lisa Louise Margaret Maria Martha Melissa Michelle Monika Nancy "
         "Nicole Olivia Pamela Petra Rebecca Rosa Ruth Sabine Sandra Sharon Sofia Stephanie Susanne Ursula Victoria Virginia".split(),
}
FAMILY_HAN = "王 李 张 刘 陈 杨 赵 黄 周 吴 徐 孙 胡 朱 高 林 何 郭 马 罗".split()
#: Syllables that make up family names (and further given names) of a script.
SYLLABLES = {
    "latin": "ba ber bran cal cor dal den dor el fen gar hal har ker lan len lin mar mel mor nel nor ol per ras rin ros sal sel sten tal ten tor ul val vin wal wen".split(),
    "cyrillic": "ба бор ва вол га гор да дол ки ко кра ла ле ло ма мо ни но па по ра ро са со та то".split(),
    "greek": "βα γα δα κα κο λα λο μα μο να νο πα πο ρα ρο σα στα τα το φα".split(),
    "han": FAMILY_HAN,
}
ENDINGS = {"latin": "son man berg ford ley well ton mann dahl field".split(), "cyrillic": "ов ин ский ев".split(),
           "greek": "ίδης άκης όπουλος".split()}
NAME_KINDS = ("given_m", "given_f", "given_n", "family")

_DOMAIN = re.compile(r"@(?:[\w-]+\.)+[A-Za-z]{2,}(?![\w-])")
_LOCAL = re.compile(r"[\w.%+-]")
_IP4 = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)")
_IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4})(?![\w:])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_LONG = re.compile(r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?)(?![\w-])")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
                    r"|\d{3} \d{3} \d{4}|0\d(?: \d{2}){4}|[6-9]\d{2} \d{3} \d{3}|0\d{2,4}[ /-]\d{5,8})(?![\w-]| \d)")
#: Country codes whose numbers are also written without them.
_COUNTRIES = ("1", "7", "30", "33", "34", "39", "44", "49")
_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_PARTICLES = r"(?: (?:van|von|der|den|de|del|di|da|du|la|le|zu))*"
_PAIR = re.compile(rf"(?<!\w)({_WORD}) ({_WORD})")
_HAN = re.compile(r"([一-鿿])([一-鿿]{1,2})(先生|女士|小姐)")
_GENDER = {t: g for g, ts in TITLES.items() for t in ts} | {t: g for g, ts in HAN_TITLES.items() for t in ts}
_GENDER |= {form(t): g for t, g in list(_GENDER.items()) for form in (str.upper, str.lower)}
_TITLED = re.compile(rf"(?<!\w)({'|'.join(sorted(map(re.escape, _GENDER), key=len, reverse=True))})\.? (?=[^\W\d_])")
#: The names after a title: initials and words, with particles between.
_NAME = re.compile(rf"([^\W\d_]\.|{_WORD})(?:({_PARTICLES}) (?=[^\W\d_]))?")
_KNOWN = {name: gender for gender, names in KNOWN_ONLY.items() for name in names} | {name: gender for (script, gender), names in GIVEN.items() if script != "han" for name in names}


def script_of(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "han" if 0x4E00 <= c < 0xA000 else "latin"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_valid(iban: str) -> bool:
    return len(iban) >= 15 and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _titled(text: str, start: int) -> list[re.Match]:
    """The capitalised words, three at most, that stand after a title: all in capitals or none, initials apart."""
    names: list[re.Match] = []
    at = start
    while len(names) < 3 and (m := _NAME.match(text, at)):
        word = m[1]
        if not word[0].isupper() or (word.rstrip(".") in _GENDER and word.rstrip(".").lower() not in ("don", "miss", "sir")):
            break
        long = [n for n in names if len(n[1].rstrip(".")) > 1]
        if long and len(word.rstrip(".")) > 1 and word.isupper() != long[0][1].isupper():
            break
        names.append(m)
        if m[2] is None:
            break
        at = m.end()
    return names


def _named(text: str, out: list) -> None:
    words = set(text.split())
    if any(w.rstrip(".").lstrip("(\"'„“«") in _GENDER for w in words):
        for m in _TITLED.finditer(text):
            names = _titled(text, m.end())
            for i, n in enumerate(names):
                word = n[1].rstrip(".")
                # of several names the last is the family's; one alone is too, unless it is a known given name
                known = _KNOWN.get(word.title())
                kind = "family" if (i == len(names) - 1 and (i or not known)) else f"given_{known or _GENDER[m[1]]}"
                out.append((kind, f"{script_of(word)}:{_fold(word)}", n.start(1), n.start(1) + len(word)))
    if not words.isdisjoint(_KNOWN):
        for m in _PAIR.finditer(text):
            for pair in (m, _PAIR.match(text, m.start(2))):  # the second word may begin the next pair
                if pair and pair[1] in _KNOWN and pair[2][0].isupper() and pair[2] not in _GENDER:
                    out.append((f"given_{_KNOWN[pair[1]]}", f"{script_of(pair[1])}:{_fold(pair[1])}", pair.start(1), pair.end(1)))
                    out.append(("family", f"{script_of(pair[2])}:{_fold(pair[2])}", pair.start(2), pair.end(2)))
    if "先生" in text or "女士" in text or "小姐" in text:
        for m in _HAN.finditer(text):
            out.append(("family", f"han:{m[1]}", m.start(1), m.end(1)))
            out.append((f"given_{_GENDER[m[3]]}", f"han:{m[2]}", m.start(2), m.end(2)))


def _fold(word: str) -> str:
    return unicodedata.normalize("NFC", word).casefold()


def _national(phone: str) -> str:
    """A telephone number's digits without country code and trunk zero."""
    digits = _digits(phone)
    if phone.startswith("+"):
        code = next((c for c in _COUNTRIES if digits.startswith(c) and len(digits) - len(c) >= 7), "")
        digits = digits[len(code):]
    return digits[1:] if digits.startswith("0") and len(digits) > 7 else digits


def mentions(text: str | None) -> list[tuple[str, str, int, int]]:
    """(kind, normal form, start, end) of the entities of a whole text, apart from each other."""
    found: list[tuple[str, str, int, int]] = []
    if not text:
        return found
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start and _LOCAL.match(text[start - 1]):
                start -= 1
            while start < m.start() and text[start] in ".-":
                start += 1
            if start < m.start():
                found.append(("email", text[start:m.end()].casefold(), start, m.end()))
    if any(c in text for c in "0123456789"):
        for m in _IP4.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                found.append(("ip4", ".".join(str(int(x)) for x in m[0].split(".")), m.start(), m.end()))
        if ":" in text:
            for m in _IP6.finditer(text):
                try:
                    found.append(("ip6", ipaddress.IPv6Address(m[0]).exploded, m.start(), m.end()))
                except ValueError:
                    pass
        for m in _IBAN.finditer(text):
            plain = m[0].replace(" ", "")
            if iban_valid(plain):
                found.append(("iban", plain, m.start(), m.end()))
        for m in _LONG.finditer(text):
            digits = _digits(m[0])
            found.append(("card" if luhn(digits) else "account", digits, m.start(), m.end()))
        found += [("ssn", _digits(m[0]), m.start(), m.end()) for m in _SSN.finditer(text)]
        for m in _PHONE.finditer(text):
            if 7 <= len(_digits(m[0])) <= 15:
                found.append(("phone", _national(m[0]), m.start(), m.end()))
    _named(text, found)
    apart, end = [], 0
    for x in sorted(set(found), key=lambda x: (x[2], -x[3], x[0])):
        if x[2] >= end:
            apart.append(x)
            end = x[3]
    return apart


class _Draw:
    """Numbers drawn from a keyed hash of (kind, normal form, attempt)."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=key, digest_size=32).digest()
        self.n, self.pool = 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool = hashlib.blake2b(self.seed + self.n.to_bytes(4, "big"), digest_size=64).digest()
            self.n += 1
        got, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return got % n

    def of(self, choices):
        return choices[self.below(len(choices))]

    def like(self, text: str) -> str:
        """A letter for a letter, a digit for a digit, other characters as they are."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                out.append({"latin": lambda: chr(97 + self.below(26)), "cyrillic": lambda: chr(0x430 + self.below(32)),
                            "greek": lambda: chr(0x3B1 + self.below(17)), "han": lambda: self.of(FAMILY_HAN)}[script_of(c)]())
            else:
                out.append(c)
        return "".join(out)


def surrogate(kind: str, normal: str, attempt: int, key: bytes) -> str:
    """The normal form of the surrogate that an entity draws at its n-th attempt."""
    d = _Draw(key, kind, normal, attempt)
    if kind == "email":
        local, _, domain = normal.partition("@")
        host, _, top = domain.rpartition(".")
        return d.like(local) + (str(d.below(10 ** (attempt - 2))) if attempt > 3 else "") + "@" + d.like(host) + "." + top
    grown = "".join(str(d.below(10)) for _ in range(attempt // 32))  # a format that is full gives longer surrogates
    if kind == "ip4" and not grown:
        return ".".join(str(1 + d.below(254)) for _ in range(4))
    if kind in ("ip4", "ip6"):
        return ":".join(f"{d.below(1 << 16):04x}" for _ in range(8))
    if kind == "iban":
        body = "".join(str(d.below(10)) if c.isdigit() else chr(65 + d.below(26)) for c in normal[4:])
        rest = int("".join(str(int(c, 36)) for c in body + normal[:2]) + "00") % 97
        return f"{normal[:2]}{98 - rest:02d}{body}"
    if kind in ("card", "account"):
        body = str(1 + d.below(9)) + "".join(str(d.below(10)) for _ in range(len(normal) - 2))
        check = next(c for c in "0123456789" if luhn(body + c))
        if grown:
            body += grown
            check = next(c for c in "0123456789" if luhn(body + c))
        return body + (check if kind == "card" else str((int(check) + 1 + d.below(9)) % 10))
    if kind == "phone":
        keep = min(len(normal) - 6, 3) if len(normal) > 10 else 0
        return normal[:keep] + "".join(str(d.below(10)) for _ in range(len(normal) - keep)) + grown
    if kind == "ssn":
        return f"{1 + d.below(899):03d}{1 + d.below(99):02d}{1 + d.below(9999):04d}" + grown
    script, _, _ = normal.partition(":")
    if kind == "family":
        parts = [d.of(SYLLABLES[script]) for _ in range(1 if script == "han" and not attempt else 2 + attempt // 4)]
        return f"{script}:" + "".join(parts) + (d.of(ENDINGS[script]) if script in ENDINGS else "")
    gender = kind[-1] if kind[-1] != "n" else d.of("mf")
    more = "".join(d.of(SYLLABLES[script]) for _ in range((attempt + 3) // 4)) if script != "han" else \
        "".join(d.of(GIVEN[script, gender]) for _ in range(attempt // 4))
    # beyond the known names a given name is made longer, never another gender's
    return f"{script}:" + _fold(d.of(GIVEN[script, gender]) + more)


def render(kind: str, mention: str, drawn: str) -> str:
    """The surrogate in the format of a mention: its grouping, case and spelling."""
    if kind in ("card", "account", "phone", "ssn"):
        # a country code and a trunk zero stay
        keep = max(0, len(_digits(mention)) - len(_national(mention))) if kind == "phone" else 0
        it = iter(_digits(mention)[:keep] + drawn)
        return "".join(next(it, "") if c.isdigit() else c for c in mention) + "".join(it)
    if kind == "iban":
        it = iter(drawn)
        return "".join(next(it, "") if c != " " else c for c in mention)
    if kind == "ip6" or ":" in drawn and kind == "ip4":
        short = ipaddress.IPv6Address(drawn).compressed
        return short.upper() if any(c.isupper() for c in mention) else short
    name = drawn.partition(":")[2] if kind in NAME_KINDS else drawn
    if mention.isupper():
        return name.upper()
    return name.title() if kind in NAME_KINDS and mention[:1].isupper() else name


MENTIONS = "array<struct<kind: string, normal: string, start: int, end: int>>"


def mention_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """(k1, k2, mentions): the entities of every text that has any."""

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("normal", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [mentions(t.as_py()) for t in batch.column(2)]
            some = [i for i, m in enumerate(found) if m]
            rows = [[dict(zip(("kind", "normal", "start", "end"), m)) for m in found[i]] for i in some]
            take = pa.array(some, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(rows, kind)],
                                             names=["k1", "k2", "mentions"])

    narrow = docs.select(*text_key(text), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, f"k1 bigint, k2 bigint, mentions {MENTIONS}").dropDuplicates(["k1", "k2"])


def surrogate_map(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, normal, drawn): a surrogate for every distinct (kind, normal).

    Of equal surrogates the smallest entity keeps it; a surrogate that is an entity of
    the corpus, or was kept in an earlier round, is drawn again with the next attempt."""

    def run(batches):
        for batch in batches:
            drawn = [surrogate(k, n, a, key) for k, n, a in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], names=["kind", "normal", "attempt", "drawn"])

    # names of all genders are drawn apart from each other, whatever kind they have
    pool = lambda kind: F.when(F.startswith(kind, F.lit("given_")), F.lit("given")).otherwise(kind).alias("pool")
    originals = saved(entities.select("kind", "normal").distinct(), "entities")
    real = originals.select(pool(F.col("kind")), F.col("normal").alias("drawn")).distinct()
    open_, kept = originals.withColumn("attempt", F.lit(0)), None
    while True:
        cast = saved(open_.mapInArrow(run, "kind string, normal string, attempt int, drawn string"), "drawn")
        free = cast.withColumn("pool", pool(F.col("kind"))).join(real, ["pool", "drawn"], "left_anti")
        if kept is not None:
            free = free.join(kept.select(pool(F.col("kind")), "drawn"), ["pool", "drawn"], "left_anti")
        winner = F.min(F.struct("kind", "normal")).alias("w")
        won = saved(free.groupBy("pool", "drawn").agg(winner).select("w.kind", "w.normal", "drawn"), "kept")
        kept = won if kept is None else kept.unionByName(won)
        open_ = saved(cast.join(won.select("kind", "normal"), ["kind", "normal"], "left_anti")
                      .select("kind", "normal", (F.col("attempt") + 1).alias("attempt")), "collided")
        if open_.isEmpty():  # in the end surrogates grow, so all find one
            return kept


def with_gender(each: DataFrame) -> DataFrame:
    """Mentions whose neutral given names have the gender that the same name has elsewhere in the corpus (of two, the first)."""
    known = saved(each.filter("kind IN ('given_f', 'given_m')").groupBy("normal").agg(F.min("kind").alias("as_kind")), "genders")
    met = join_measured(each, known, ["normal"], "left", F.lit(96))
    return met.withColumn("kind", F.when(F.col("kind") == "given_n", F.coalesce("as_kind", "kind")).otherwise(F.col("kind"))).drop("as_kind")


def replacements(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """(k1, k2, spans): what is replaced in every text that has entities."""
    found = saved(mention_table(docs, text), "mentions")
    each = with_gender(found.select("k1", "k2", F.explode("mentions").alias("m")).select("k1", "k2", "m.*"))
    drawn = saved(surrogate_map(each, key), "surrogates")
    met = each.join(drawn, ["kind", "normal"])
    return saved(met.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "drawn"))).alias("spans")), "spans")


def rewrite(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for s in spans:
        out += [text[at:s["start"]], render(s["kind"], text[s["start"]:s["end"]], s["drawn"])]
        at = s["end"]
    return "".join([*out, text[at:]])


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", counts: str | None = None) -> DataFrame:
    """All rows and columns with surrogates in place of entities; ``counts`` names
    a column for the number of replaced mentions."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body = names.index(text)
    spans = replacements(inner, key, f"c{body}")
    marked = join_measured(inner.select("*", *text_key(f"c{body}")), spans, ["k1", "k2"], "left", 64 + 64 * F.size("spans"))
    marked = marked.select(*inner.columns, "spans")
    fields = [T.StructField(f"c{i}", T.StringType() if i == body else docs.schema[n].dataType) for i, n in enumerate(names)]
    schema = T.StructType([*fields, T.StructField("n", T.LongType())])

    def run(batches):
        for batch in batches:
            spans = batch.column(len(names)).to_pylist()
            texts = [rewrite(t.as_py(), s) if s else t.as_py() for t, s in zip(batch.column(body), spans)]
            columns = list(batch.columns[:len(names)])
            columns[body] = pa.array(texts, pa.string())
            columns.append(pa.array([len(s or ()) for s in spans], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    out = marked.mapInArrow(run, schema).toDF(*names, "\0n")
    return out.withColumnRenamed("\0n", counts) if counts else out.drop("\0n")
