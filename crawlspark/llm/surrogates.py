"""Personal data and secrets get surrogates.

Entities (mail addresses, phone, card and account numbers, IPv4 addresses, social security numbers, secrets, names of
persons) are found by patterns. Each has a canonical form: the digits of a number, a lower-case address, a name's part.
Its surrogate is drawn from a keyed hash of kind, canonical form and attempt, and put into each mention's own format:
digits stay digits, letters keep case and alphabet, separators, country codes, top-level domains and lengths stay, a
card number that passes its checksum is replaced by one that does, a name by one of the same gender and script. Equal
entities get equal surrogates in all texts and formats; the parts of a name are replaced apart, so a family name alone
still refers to the full name.

Distinctness is checked over the whole corpus: where two entities of a kind draw the same surrogate, or one draws what
is a real entity, the later draws again, until no such case is left. Nearly all entities keep their first draw, which a
task computes by itself; only redrawn ones must be looked up. Up to ``CARRIED`` of them go with the tasks (the number is
checked), more are joined by row.

Null texts stay null, empty ones empty. Without a key two runs differ in nothing: the default key is fixed; give your
own. Further columns stay; equal rows are rewritten equally.
"""

from __future__ import annotations

import hashlib
import hmac
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.llm.shared import fresh, staged

KEY = b"surrogates"
CARRIED = 10_000
ROUNDS = 50

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Common given names by gender and script.
GIVEN = {
    ("f", "latin"): "Alice Anna Carla Carmen Charlotte Claire Clara Elena Elizabeth Emily Emma Eva Helen Ines Isabel Jane Jennifer Julia Karen Katharina Laura Linda Lucia Margaret Maria Marie Martha Mary Monica Nancy Olivia Patricia Paula Rosa Sarah Sofia Sophie Susan Teresa Ursula".split(),
    ("m", "latin"): "Alexander Andreas Anthony Antonio Carlos Charles Christian Daniel David Diego Edward Felix Francisco Frank George Hans Henri Jack Jacques James Jean John Jorge Joseph Juan Karl Klaus Luis Manuel Michael Miguel Paul Pedro Peter Philippe Pierre Richard Robert Thomas William".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Марина Мария Надежда Наталья Ольга Светлана Татьяна".split(),
    ("m", "cyrillic"): "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Сергей Юрий".split(),
    ("f", "greek"): "Άννα Ελένη Μαρία Σοφία Κατερίνα Ειρήνη".split(),
    ("m", "greek"): "Γιώργος Δημήτρης Κώστας Νίκος Παύλος Γιάννης".split(),
}
# Syllables from which further names are built, and their endings by gender.
SYLLABLES = {"latin": "ba be bo da de do fa fe ga go ha he ka ke la le lo ma me mi na ne no pa pe ra re ro sa se ta te to va ve wa".split(),
             "cyrillic": "ба бе бо ва ве га го да де до ка ко ла ле ло ма ме ми на не но па по ра ре ро са се та те то".split(),
             "greek": "βα γα δα θε κα λα λε μα μι να νε πα ρα σα τα το φα".split()}
ENDINGS = {("f", "latin"): "na", ("m", "latin"): "n", ("f", "cyrillic"): "на", ("m", "cyrillic"): "н", ("f", "greek"): "να", ("m", "greek"): "ς",
           ("", "latin"): "r", ("", "cyrillic"): "в", ("", "greek"): "ς"}
TITLES = {"m": "Mr Sir Herr Señor Monsieur Sr", "f": "Mrs Ms Miss Madam Frau Señora Madame Mme Sra", "": "Dr Prof Professor"}
GENDER = {name: g for (g, _), names in GIVEN.items() for name in names}
TITLE_GENDER = {t: g for g, titles in TITLES.items() for t in titles.split()}
_CAPITAL = r"[^\W\d_a-z][^\W\d_]+(?:-[^\W\d_]+)?"
PATTERNS = {
    "secret": r"(?i:token|secret|api[_-]?key|access[_-]?key|password|passwd)[\"']?\s*[=:]\s*[\"']?(?P<secret>(?=[A-Za-z0-9_+/=-]*\d)[A-Za-z0-9_+/=-]{8,})|(?<!\w)(?P<hex>(?=[0-9a-fA-F]*\d)(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,})(?!\w)",
    "email": r"(?<![\w.+-])(?P<email>\w[\w.%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})(?![\w@])",
    "iban": r"(?<!\w)(?P<iban>[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)",
    "ip": rf"(?<![\w.])(?P<ip>(?:{OCTET}\.){{3}}{OCTET})(?!\w|\.\d)",
    "ssn": r"(?<![\w-])(?P<ssn>\d{3}-\d\d-\d{4})(?![\w-])",
    "card": r"(?<![\w.+-])(?P<card>\d(?:[ -]?\d){12,18})(?![\w]|[.-]\d)",
    "phone": r"(?<![\w.+-])(?P<phone>\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}|(?:1[ .-])?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4})(?![\w]|[.-]\d)",
}
NAMES = (rf"(?<!\w)(?:(?P<title>{'|'.join(sorted(TITLE_GENDER, key=len, reverse=True))})\.?\x20(?P<called>{_CAPITAL}(?:\x20{_CAPITAL})?)"
         rf"|(?P<given>{'|'.join(sorted(GENDER, key=len, reverse=True))})\x20(?P<family>{_CAPITAL}))(?!\w)")
FIND = re.compile("|".join([*PATTERNS.values(), NAMES]))
# What any entity holds; other texts are not searched.
HINT = re.compile(rf"[@\d]|(?<!\w)(?:{'|'.join(sorted([*TITLE_GENDER, *GENDER], key=len, reverse=True))})\.? ")
NUMBERS = ("card", "phone", "ssn")


def script(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "")
            return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"
    return "latin"


def canonical(kind: str, mention: str) -> str:
    if kind in NUMBERS:
        return "".join(c for c in mention if c.isdigit())
    if kind == "iban":
        return mention.replace(" ", "")
    return mention.lower() if kind == "email" else mention if kind == "secret" else mention if kind == "ip" else unicodedata.normalize("NFC", mention).casefold()


def entities(text: str | None) -> list[tuple[int, int, str]]:
    """(begin, end, kind) of every entity of a text, in order; a name's parts are entities of their own."""
    if not text or not HINT.search(text):
        return []
    found = []
    for m in FIND.finditer(text):
        kind = m.lastgroup
        if kind == "called":
            gender = TITLE_GENDER[m["title"]]
            begin, parts = m.start("called"), m["called"].split(" ")
            if len(parts) == 2:
                gender = GENDER.get(parts[0], gender)
                found.append((begin, begin + len(parts[0]), f"given-{gender}-{script(parts[0])}"))
            found.append((m.end("called") - len(parts[-1]), m.end("called"), f"family-{script(parts[-1])}"))
        elif kind == "family":
            found.append((m.start("given"), m.end("given"), f"given-{GENDER[m['given']]}-{script(m['given'])}"))
            found.append((m.start("family"), m.end("family"), f"family-{script(m['family'])}"))
        else:
            found.append((m.start(kind), m.end(kind), "secret" if kind == "hex" else kind))
    return found


class Stream:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts):
        self.key, self.parts, self.turn = key, json.dumps(parts).encode(), 0
        self.left, self.limit = 0, 1

    def below(self, n: int) -> int:
        if self.limit < n << 32:
            self.left = int.from_bytes(hmac.digest(self.key, self.parts + self.turn.to_bytes(4, "big"), hashlib.sha256), "big")
            self.limit, self.turn = 1 << 256, self.turn + 1
        self.left, out = divmod(self.left, n)
        self.limit //= n
        return out


def luhn(digits: str) -> int:
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10


HEX = set("0123456789abcdefABCDEF")


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of a canonical form, canonical as well."""
    draw = Stream(key, kind, entity, attempt)
    if kind.startswith(("given", "family")):
        _, gender, alphabet = kind.split("-") if kind.startswith("given") else ("", "", kind.split("-")[1])
        pool = GIVEN.get((gender, alphabet))
        if pool and attempt < 3:
            return pool[draw.below(len(pool))].casefold()
        syllables = SYLLABLES[alphabet]
        return "".join(syllables[draw.below(len(syllables))] for _ in range(3 + attempt // 8)) + ENDINGS.get((gender, alphabet), ENDINGS["", alphabet])
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) if k in (0, 3) else str(draw.below(256)) for k in range(4))
    if kind in NUMBERS:
        keep = 1 if kind == "phone" and len(entity) > 10 else 0
        body = entity[:keep] + (str(1 + draw.below(9)) if entity[keep] != "0" else "0") + "".join(str(draw.below(10)) for _ in entity[keep + 1:])
        if kind == "card":  # the last digit settles the checksum as it was
            body = next(b for d in range(10) if (luhn(b := body[:-1] + str((int(body[-1]) + d) % 10)) == 0) == (luhn(entity) == 0))
        return body
    fixed = len(entity) - entity[::-1].index(".") - 1 if kind == "email" else len(entity)
    hexes = kind == "secret" and all(c in HEX for c in entity)
    out = []
    for k, c in enumerate(entity):
        if k >= fixed or (kind == "iban" and k < 2):
            out.append(c)
        elif hexes:
            out.append(("0123456789ABCDEF" if c.isupper() else "0123456789abcdef")[draw.below(16)])
        elif c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            out.append(chr(draw.below(26) + (65 if c.isupper() else 97)))
        else:
            out.append(c)
    return "".join(out)


def render(kind: str, mention: str, replacement: str) -> str:
    """A canonical replacement in the format of a mention."""
    if kind in NUMBERS:
        digits = iter(replacement)
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == "iban":
        rest = iter(replacement)
        return "".join(c if c == " " else next(rest) for c in mention)
    if kind == "email":
        return "".join(r.upper() if m.isupper() else r for m, r in zip(mention, replacement, strict=True)) if len(mention) == len(replacement) else replacement
    if kind.startswith(("given", "family")):
        return replacement.upper() if mention.isupper() else replacement.title()
    return replacement


def rewrite(text: str | None, key: bytes, redrawn: dict[tuple[str, str], int]) -> tuple[str | None, int]:
    """The text with all entities replaced, and their number."""
    found = entities(text)
    out, at = [], 0
    for begin, end, kind in found:
        mention = text[begin:end]
        entity = canonical(kind, mention)
        out += [text[at:begin], render(kind, mention, surrogate(key, kind, entity, redrawn.get((kind, entity), 0)))]
        at = end
    return ("".join(out) + text[at:] if found else text), len(found)


def mentions(df: DataFrame, text: str = "text", row: list[str] | None = None) -> DataFrame:
    """kind and entity of each mention (each once a text), with the columns named in ``row``."""
    row = row or []

    def run(frames):
        for frame in frames:
            out = [(*key, kind, entity) for value, *key in frame[[text, *row]].itertuples(index=False)
                   for kind, entity in dict.fromkeys((k, canonical(k, value[b:e])) for b, e, k in entities(value))]
            yield pd.DataFrame(out, columns=[*row, "kind", "entity"])

    schema = T.StructType([df.schema[c] for c in row] + [T.StructField("kind", T.StringType()), T.StructField("entity", T.StringType())])
    return df.select(text, *row).mapInPandas(run, schema)


def redraws(df: DataFrame, text: str = "text", key: bytes = KEY) -> DataFrame:
    """kind, entity, attempt of the entities that must not keep their first draw, so that all surrogates are distinct and
    none is a real entity."""
    @F.pandas_udf("string")
    def draw(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, e, a) for k, e, a in zip(kind, entity, attempt, strict=True)], dtype="object")

    state = staged(mentions(df, text).distinct().withColumn("attempt", F.lit(0)).withColumn("drawn", draw("kind", "entity", "attempt")), "entities")
    for _ in range(ROUNDS):
        # Each surrogate once as drawn, in the order of attempts, and once as a real entity, which comes first.
        marked = state.select("kind", F.col("drawn").alias("form"), "attempt", "entity").unionByName(
            state.select("kind", F.col("entity").alias("form"), F.lit(-1).alias("attempt"), "entity"))
        first = F.min(F.struct("attempt", "entity"))
        firsts = marked.groupBy("kind", "form").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        firsts = firsts.select(F.col("kind").alias("_kind"), F.col("form").alias("_form"), "first")
        lost = state.join(firsts, (F.col("kind") == F.col("_kind")) & (F.col("drawn") == F.col("_form"))).filter(F.struct("attempt", "entity") != F.col("first"))
        lost = staged(lost.select(F.col("kind").alias("_kind"), F.col("entity").alias("_entity")), "redrawn")
        if lost.isEmpty():
            return state.filter("attempt > 0").select("kind", "entity", "attempt")
        again = state.join(lost, (F.col("kind") == F.col("_kind")) & (F.col("entity") == F.col("_entity")), "left")
        attempt = F.col("attempt") + F.when(F.col("_kind").isNull(), 0).otherwise(1)
        state = staged(again.select("kind", "entity", attempt.alias("attempt"), "drawn", F.col("_kind").alias("_lost"))
                       .withColumn("drawn", F.when(F.col("_lost").isNull(), F.col("drawn")).otherwise(draw("kind", "entity", "attempt"))).drop("_lost"), "entities")
    raise RuntimeError("surrogates stay ambiguous: a kind has more entities than its format has values")


def replace(df: DataFrame, text: str = "text", key: bytes = KEY, count: str | None = None, carried: int = CARRIED) -> DataFrame:
    """``df`` with the entities of ``text`` replaced; ``count`` names a column for their number."""
    again = redraws(df, text, key)
    some = again.limit(carried + 1).collect()
    names = [c for c in df.columns if c != count]
    fields = [df.schema[c] for c in names] + ([T.StructField(count, T.LongType())] if count else [])
    if len(some) <= carried:
        shared = {(r["kind"], r["entity"]): r["attempt"] for r in some}
        rows, extra = df.select(*names), None
    else:
        shared, (extra, row) = {}, fresh(df, "_redrawn", "_row")
        own = mentions(df.select(text, F.xxhash64(text).alias(row)), text, [row]).distinct()
        per_row = own.join(again, ["kind", "entity"]).groupBy(row).agg(F.to_json(F.collect_list(F.struct("kind", "entity", "attempt"))).alias(extra))
        rows = df.select(*names, F.xxhash64(text).alias(row)).join(per_row, row, "left").drop(row)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            plus = batch.column(extra).to_pylist() if extra else [None] * batch.num_rows
            done = [rewrite(value, key, {(r["kind"], r["entity"]): r["attempt"] for r in json.loads(p)} if p else shared)
                    for value, p in zip(batch.column(text).to_pylist(), plus, strict=True)]
            new = {text: pa.array([t for t, _ in done], pa.string()), count: pa.array([n for _, n in done], pa.int64())}
            yield pa.RecordBatch.from_arrays([new[f.name] if f.name in (text, count) else batch.column(f.name) for f in fields], names=[f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))
