"""Personal data replaced by keyed surrogates of the same type and format.

Entities are found by pattern and by name lists, and known by a canonical form
(digits of a number, lower case of an address), so that one entity has one
surrogate wherever it occurs and however it is written.  A surrogate is drawn
with a keyed hash: letters of the same script and case, digits, hexadecimal
digits, valid check digits, names of the same gender and script.  A family name
is an entity of its own, so that a person named with a title and one named in
full stay one; given names are drawn for the whole name.  All distinct
entities of the table are then checked for collisions, with each other and with
entities that really occur, and the losers draw again until none is left.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.tables import free_name, stage, values
from encore.sources.staging import Workspace

FOUND = "array<struct<kind:string,start:int,length:int,entity:string>>"
# draws after which a surrogate may get longer, so that a full format cannot stop the search
SAME_LENGTH_DRAWS = 24
# the same for given names, of which a list holds few
LISTED_DRAWS = 3
# draws after which an address is one of the block reserved for documentation, which has room for all
DOTTED_DRAWS = 2 * SAME_LENGTH_DRAWS

# fixed values: given names by gender and script
NAMES = {
    ("f", "latin"): "Anna Maria Emma Sofia Laura Julia Sarah Lisa Elena Clara Marie Alice Eva Nina Emily Olivia",
    ("m", "latin"): "Peter Paul Thomas Michael David Daniel Martin Lukas Felix Simon James Robert Hugo Carlos Jean Louis",
    ("f", "cyrillic"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана Юлия Екатерина",
    ("m", "cyrillic"): "Иван Пётр Сергей Алексей Дмитрий Андрей Михаил Николай Владимир Павел",
    ("f", "greek"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική",
    ("m", "greek"): "Γεώργιος Ιωάννης Κωνσταντίνος Δημήτριος Νικόλαος Παναγιώτης",
}
NAMES = {group: names.split() for group, names in NAMES.items()}
GROUP_OF = {name: group for group, names in NAMES.items() for name in names}
# fixed values: titles that come before a name, by gender
TITLES = {"f": "Mrs Ms Miss Frau Mme Madame Sra Señora Signora", "m": "Mr Herr Monsieur Sr Señor Signor"}
TITLES = {gender: titles.split() for gender, titles in TITLES.items()}
GENDER_OF = {title: gender for gender, titles in TITLES.items() for title in titles}

ALPHABETS = {
    "latin": ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "cyrillic": ("абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    "greek": ("αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
}

# longest first: what an earlier pattern took is not looked at again
PATTERNS = (
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")),
    ("email", re.compile(r"[^\W_][\w.+%-]*@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[0-9A-Za-z]{24,}(?![0-9A-Za-z])")),
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")),
    ("card", re.compile(r"(?<!\d)(?<!\d[ -])\d(?:[ -]?\d){12,18}(?![ -]?\d)")),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)")),
    ("phone", re.compile(r"(?<![\w+])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
)
# fixed values: words in small letters inside a family name
PARTICLES = "von vom zu van de der den da di du del della la le ter ten".split()
_TITLE = "|".join(sorted(GENDER_OF, key=len, reverse=True))
_GIVEN = "|".join(sorted(GROUP_OF, key=len, reverse=True))
# capitalised words, also with hyphens and apostrophes; a run ends before a title
_WORD = rf"(?!(?:{_TITLE})\b)\p{{Lu}}[\p{{L}}\p{{M}}]*+(?:['\u2019-][\p{{L}}\p{{M}}]++)*+"
_RUN = rf"{_WORD}(?: (?:(?:{'|'.join(PARTICLES)}) )*+{_WORD})*+"
TITLED = regex.compile(rf"\b({_TITLE})\.? ((?:(?:{'|'.join(PARTICLES)}) )*+{_RUN})")
NAMED = regex.compile(rf"\b({_GIVEN})(?= (?:(?:{'|'.join(PARTICLES)}) )*+{_WORD}){_RUN[len(_WORD):]}")
DIGIT = re.compile(r"\d")
# fixed values: country codes of one and two digits; all others have three, and none begins another
COUNTRY = re.compile(
    r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3})"
)
# what either pattern begins with; most texts have none
ANY_NAME = re.compile(r"\b(?:" + "|".join(sorted({*GENDER_OF, *GROUP_OF}, key=len, reverse=True)) + r")\b")


def script_of(word: str) -> str:
    for name, (small, large) in ALPHABETS.items():
        if any(c in small or c in large for c in word):
            return name
    return "latin"


def _letters(surface: str) -> str:
    return re.sub(r"[^0-9A-Za-z]", "", surface)


def _is_iban(surface: str) -> bool:
    plain = _letters(surface)
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _canonical(kind: str, surface: str) -> str:
    if kind == "phone":
        # without a country code only the format of the code 1 is looked for
        return ("+" if surface[0] == "+" else "+1") + re.sub(r"\D", "", surface)
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", surface)
    if kind == "iban":
        return _letters(surface)
    if kind == "secret":
        # only hexadecimal digits of one case are the same in the other
        folds = all(c in "0123456789abcdef" for c in surface.lower()) and (surface.isupper() or surface.islower())
        return surface.lower() if folds else surface
    return surface.lower() if kind == "email" else surface


def _patterned(text: str) -> Iterator[tuple[str, int, int, str]]:
    for kind, pattern in PATTERNS:
        for match in pattern.finditer(text):
            surface = match[0]
            if kind == "iban":
                # a following word may look like one more part
                while not _is_iban(surface) and " " in surface:
                    surface = surface.rpartition(" ")[0]
                if not _is_iban(surface):
                    continue
            yield kind, match.start(), match.start() + len(surface), _canonical(kind, surface)


def _name(gender: str, start: int, surface: str) -> Iterator[tuple[str, int, int, str]]:
    """The given and the family part of a name; a single word is a family name unless it is a known given one."""
    words = surface.split(" ")
    particles = [i for i, word in enumerate(words) if word in PARTICLES]
    n_given = particles[0] if particles else len(words) - 1
    if len(words) == 1 and surface in GROUP_OF:
        n_given = 1
    given, family = " ".join(words[:n_given]), " ".join(words[n_given:])
    if given:
        yield f"given-{gender}", start, start + len(given), f"{given.lower()}|{family.lower()}"
    if family:
        yield "family", start + len(surface) - len(family), start + len(surface), family.lower()


def _names(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Capitalised words after a title, or after a known given name."""
    for match in TITLED.finditer(text):
        yield from _name(GENDER_OF[match[1]], match.start(2), match[2])
    for match in NAMED.finditer(text):
        yield from _name(GROUP_OF[match[1]][0], match.start(), match[0])


def find(text: str) -> list[dict]:
    """The entities of one text in order, without overlaps; what was found first stays."""
    starts: list[int] = []
    found: list[dict] = []
    candidates: list[tuple[str, int, int, str]] = []
    if "@" in text or DIGIT.search(text):
        candidates += _patterned(text)
    if ANY_NAME.search(text):
        candidates += _names(text)
    for kind, start, end, entity in candidates:
        at = bisect(starts, start)
        before_ends = at == 0 or found[at - 1]["start"] + found[at - 1]["length"] <= start
        if before_ends and (at == len(starts) or end <= starts[at]):
            starts.insert(at, start)
            found.insert(at, {"kind": kind, "start": start, "length": end - start, "entity": entity})
    return found


# --- surrogates ------------------------------------------------------------------


class _Stream:
    """Numbers that only the key, the entity and the draw determine."""

    def __init__(self, key: bytes, *about: str):
        self.key, self.about, self.block, self.rest = key, "\0".join(about).encode(), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        if self.bits < 64:
            self.block += 1
            digest = hmac.new(self.key, self.about + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.rest, self.bits = int.from_bytes(digest, "big"), 256
        self.rest, value = divmod(self.rest, n)
        self.bits -= n.bit_length()
        return value

    def like(self, c: str) -> str:
        """Another character of the same sort; punctuation stays."""
        if c.isdigit():
            return str(self.below(10))
        if not c.isalpha():
            return c
        small, large = ALPHABETS[script_of(c)]
        return (large if c.isupper() else small)[self.below(len(small))]


def _check_digit(digits: str) -> str:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def surrogate(kind: str, entity: str, draw: int, key: bytes) -> str:
    """The canonical form of an entity's surrogate at a draw."""
    stream = _Stream(key, kind, entity, str(draw))
    free = LISTED_DRAWS if kind.startswith("given-") else SAME_LENGTH_DRAWS
    more = "".join(str(stream.below(10)) for _ in range(max(0, draw - free)))
    if kind == "ip":
        if draw > DOTTED_DRAWS:
            return "2001:db8:" + ":".join(f"{stream.below(1 << 16):04x}" for _ in range(6))
        if draw > SAME_LENGTH_DRAWS:
            return ".".join(str(stream.below(256)) for _ in range(4))
        ranges = {1: (0, 10), 2: (10, 100), 3: (100, 256)}
        return ".".join(
            str(low + stream.below(high - low)) for low, high in (ranges[len(part)] for part in entity.split("."))
        )
    if kind == "secret":
        if any(c not in "0123456789abcdef" for c in entity.lower()):
            return "".join(map(stream.like, entity)) + more
        drawn = "".join("0123456789abcdef"[stream.below(16)] for _ in entity)
        # a key of mixed case keeps it place by place
        return _cased(entity, drawn) + more
    if kind == "iban":
        account = "".join(map(stream.like, entity[4:])) + more
        rest = int("".join(str(int(c, 36)) for c in account + entity[:2]) + "00") % 97
        return f"{entity[:2]}{98 - rest:02}{account}"
    if kind == "email":
        name, _, domain = entity.partition("@")
        host, _, top = domain.rpartition(".")
        return "".join(map(stream.like, name)) + more + "@" + "".join(map(stream.like, host)) + "." + top
    if kind == "phone":
        # however the number is written, its country code stays and all other digits are drawn
        code = COUNTRY.match(entity)[0]
        return code + "".join(map(stream.like, entity[len(code) :])) + more
    if kind == "card":
        luhn = _check_digit(entity[:-1]) == entity[-1]
        digits = "".join(map(stream.like, entity[:-1]))
        return digits + (_check_digit(digits) if luhn else stream.like("0")) + more
    if kind.startswith("given-"):
        # the family name goes along: persons have to differ in one of both
        given, _, family = entity.partition("|")
        known = NAMES[kind[-1], script_of(given)]
        made = " ".join(known[stream.below(len(known))].lower() for _ in given.split(" "))
        return f"{made}{''.join(stream.like(known[0][-1]) for _ in more)}|{family}"
    if kind == "family":
        words = [w if w in PARTICLES else "".join(map(stream.like, w)) for w in entity.split(" ")]
        return " ".join(words) + "".join(stream.like(entity[-1]) for _ in more)
    return "".join(map(stream.like, entity)) + more


def _cased(surface: str, drawn: str) -> str:
    """``drawn`` with capitals where ``surface`` has some."""
    return "".join(c.upper() if surface[i : i + 1].isupper() else c for i, c in enumerate(drawn))


def _dressed(kind: str, surface: str, canonical: str) -> str:
    """A canonical surrogate written the way the entity was written."""
    if kind in ("card", "phone", "ssn", "iban"):
        if kind == "phone" and surface[0] != "+":
            canonical = canonical.removeprefix("+1")
        written = iter(canonical.removeprefix("+"))
        return "".join(next(written) if c.isalnum() else c for c in surface) + "".join(written)
    if kind in ("email", "secret"):
        return canonical.upper() if surface.isupper() else canonical
    if kind == "family":
        # what got longer goes on in the case of the last letter
        return _cased(surface + surface[-1] * max(0, len(canonical) - len(surface)), canonical)
    if kind.startswith("given-"):
        given = canonical.partition("|")[0]
        return given.upper() if surface.isupper() and len(surface) > 1 else given.title()
    return canonical


def _found(schema_names: list[str], text: str, name: str):
    at = schema_names.index(text)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32()), ("entity", pa.string())])
    )

    def find_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([find(text) for text in values(batch.column(at), "")], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*schema_names, name])

    return find_all


def _drawn(key: bytes):
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                surrogate(kind, entity, number, key)
                for kind, entity, number in zip(*(values(batch.column(i)) for i in range(3)), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=["kind", "entity", "draw", "surrogate"]
            )

    return draw


def draw_surrogates(entities: DataFrame, key: bytes, work: Workspace) -> DataFrame:
    """``kind``, ``entity`` and a ``surrogate`` that no other entity of the kind has or is.

    The smallest entity keeps a surrogate several have drawn; one that is itself
    an entity of the table is given up.  Only losers draw again.
    """
    schema = "kind string, entity string, draw int, surrogate string"
    known = stage(entities.select("kind", "entity").distinct(), "entities", work)
    drawn = stage(known.withColumn("draw", F.lit(0)).mapInArrow(_drawn(key), schema), "drawn", work)
    real = known.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("_real"))
    while True:
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("_first"), F.count("*").alias("_n"))
        bad = first.join(real, ["kind", "surrogate"], "left").where(F.col("_real") | (F.col("_n") > 1))
        bad = bad.select("kind", "surrogate", F.when(F.col("_real").isNull(), F.col("_first")).alias("_first"))
        marked = stage(
            drawn.join(bad.withColumn("_bad", F.lit(True)), ["kind", "surrogate"], "left").select(
                "kind",
                "entity",
                "draw",
                "surrogate",
                (F.col("_bad").isNotNull() & ~F.col("entity").eqNullSafe(F.col("_first"))).alias("_lost"),
            ),
            "marked",
            work,
        )
        losers = marked.where("_lost")
        if not losers.head(1):
            return drawn.select("kind", "entity", "surrogate")
        again = losers.select("kind", "entity", (F.col("draw") + 1).alias("draw")).mapInArrow(_drawn(key), schema)
        drawn = stage(marked.where("NOT _lost").drop("_lost").unionByName(again), "drawn", work)


def _rewritten(names: list[str], text: str, spans: str):
    at, spans_at = names.index(text), names.index(spans)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for original, spans in zip(values(batch.column(at)), values(batch.column(spans_at)), strict=True):
                parts, done = [], 0
                for span in sorted(spans, key=lambda x: x["start"]):
                    end = span["start"] + span["length"]
                    surface = original[span["start"] : end]
                    parts += original[done : span["start"]], _dressed(span["kind"], surface, span["surrogate"])
                    done = end
                texts.append("".join([*parts, original[done:]]))
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rewrite


def replace(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in its texts, and their number as ``_n_entities``.

    Who knows ``key`` can recompute the surrogate of any guessed entity: keep it secret.
    A name counts as two, its given and its family part.
    Every row comes back with its own columns.  A text without entities, empty or
    null, comes back as it is.  Repeated rows are rewritten alike; the same entity
    has the same surrogate in all rows, different entities have different ones.
    An empty table gives an empty one.  Where ``docs`` has a column ``_n_entities``,
    the number gets a name with more underscores before it.
    """
    work = Workspace(docs.sparkSession)
    found, row, placed, number = (
        free_name(name, docs.columns) for name in ("_found", "_row", "_spans", "_n_entities")
    )
    schema = T.StructType([*docs.schema.fields, T.StructField(found, T._parse_datatype_string(FOUND))])
    looked = docs.mapInArrow(_found(docs.columns, text, found), schema)
    plain = looked.where(F.size(found) == 0).drop(found).withColumn(number, F.lit(0).cast("long"))
    # only texts with an entity are written and shuffled
    hits = stage(looked.where(F.size(found) > 0).withColumn(row, F.monotonically_increasing_id()), "hits", work)
    occurrences = hits.select(row, F.explode(found).alias("_at")).select(row, "_at.*")
    drawn = stage(draw_surrogates(occurrences, key, work), "surrogates", work)
    spans = (
        occurrences.join(drawn, ["kind", "entity"])
        .groupBy(row)
        .agg(F.collect_list(F.struct("kind", "start", "length", "surrogate")).alias(placed))
    )
    dressed = hits.drop(found).join(spans, row).drop(row)
    rewritten = dressed.mapInArrow(_rewritten(dressed.columns, text, placed), dressed.schema)
    rewritten = rewritten.withColumn(number, F.size(placed).cast("long")).drop(placed)
    return plain.unionByName(rewritten)
