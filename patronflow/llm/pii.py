"""Operator 8: replace personal data by surrogates.

Detected entities (mail addresses, phone numbers, IPv4 addresses, card numbers,
secrets, titled names) get replacements that depend on a secret key and on the
entity alone, so every mention of an entity gets the same one, in any document
and task, without a lookup. A replacement has the type, script, gender and
format of what it replaces: letters stay letters of that script, digits stay
digits with the same punctuation, a card number keeps its check digit valid, a
name keeps the gender of its title.

Two entities must not share a replacement, nor may a replacement be an entity of
the corpus. This is checked over the distinct entities of the whole table: those
in conflict are numbered anew until none is left (with its number a name gets
more syllables, and from :data:`GROW` on other replacements more characters, so
that there are always more replacements than entities), and their numbers
(:data:`BROADCAST_ROWS` at most, else they are joined to the texts) go into the
replacing pass.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import few_files, free_name, map_texts, store

BROADCAST_ROWS = 100_000
#: Number from which a replacement is longer than its entity by a character each.
GROW = 4

# Titles before names, with the gender they state.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Madam": "f",
    "Herr": "m", "Herrn": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mademoiselle": "f", "Mme": "f", "Mlle": "f",
    "Señor": "m", "Señora": "f", "Señorita": "f", "Sr": "m", "Sra": "f", "Srta": "f",
    "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
    "Dr": "", "Prof": "",
}
# Surrogate name parts by script and gender ("" fits both).
NAMES = {
    "latin": {"m": "Alan Boris Carl Denis Emil Felix Georg Hugo Ivan Jonas Karl Louis Marco Nils Oscar Paul",
              "f": "Alma Berta Clara Dora Emma Flora Greta Helen Ida Julia Karla Lena Maria Nora Olga Paula",
              "": "Alex Chris Dana Eden Kim Lee Noel Robin Sam Toni"},
    "cyrillic": {"m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл",
                 "f": "Анна Вера Галина Дарья Елена Зоя Ирина Ксения", "": "Саша Женя Валя"},
    "greek": {"m": "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Νίκος", "f": "Άννα Ελένη Ζωή Ιωάννα Μαρία Σοφία",
              "": "Αλέξ Χριστάκη"},
}
FAMILY = {
    "latin": "bal ber dan der fal gar hol kal lan mar nor pal ran sal tor val win zel",
    "cyrillic": "бал вер дан гар кол лан мар нор пав ром сол тор",
    "greek": "βαλ γαρ δαν καλ λαν μαρ νορ παλ ραν σολ",
}
_ENDS = {"latin": "son", "cyrillic": "ко", "greek": "ης"}

_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
_NAME = r"[^\W\d_a-z]\w+(?:[-'’]\w+)?"
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])[\w+-][\w.+-]*@[\w-]+(?:\.[\w-]+)+")),
    ("secret", re.compile(r"(?i)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s*[:=]\s*[\"']?"
                          r"(?P<v>[A-Za-z0-9_/+=-]{8,})")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?P<v>[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")),
    ("card", re.compile(r"(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)|\d{1,5})|\(\d{2,5}\))"
                         r"(?:[ .-]?\d{2,5}){1,4}(?!\w)")),
    ("name", re.compile(rf"(?<!\w)(?P<t>{_TITLE})\.? (?P<v>{_NAME}(?: {_NAME})?)")),
]
_SECRET_WORDS = ("token", "secret", "passw", "key")
_DIGIT_KINDS = {"ip", "card", "phone"}
_TITLE_STARTS = tuple(sorted({t[:2] for t in TITLES}))


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, mention)`` of the entities, in order and without
    overlap; the first pattern that matches a place wins. Plain substring tests
    come first, as most texts have nothing to find."""
    found: list[tuple[int, int, str, str]] = []
    has_digit = any(d in text for d in "0123456789")
    rest = text
    for kind, pattern in PATTERNS:
        if kind == "email":
            wanted = "@" in text
        elif kind in _DIGIT_KINDS:
            wanted = has_digit
        elif kind == "name":
            wanted = any(t in text for t in _TITLE_STARTS)
        elif pattern.flags & re.IGNORECASE:
            lowered = text.lower()
            wanted = any(w in lowered for w in _SECRET_WORDS)
        else:  # a long hexadecimal number has a digit but for a chance of 1e-6
            wanted = has_digit
        if not wanted:
            continue
        spans = []
        for m in pattern.finditer(rest):
            a, b = m.span("v") if "v" in pattern.groupindex else m.span()
            name = kind + (":" + TITLES[m["t"]] if kind == "name" else "")
            found.append((a, b, name, text[a:b]))
            spans.append((a, b))
        if spans:  # later patterns see gaps of the same length
            pieces, at = [], 0
            for a, b in spans:
                pieces += [rest[at:a], "\0" * (b - a)]
                at = b
            rest = "".join(pieces) + rest[at:]
    return sorted(found)


def canonical(kind: str, mention: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("card", "phone"):
        return re.sub(r"\D", "", mention)
    if kind == "email":
        return mention.lower()
    if kind.startswith("name"):
        return mention.casefold()
    return mention


def _stream(key: bytes, kind: str, entity: str, turn: int):
    """Keyed numbers 0..2**32-1 without end."""
    block = 0
    while True:
        data = hmac.new(key, f"{kind}\0{entity}\0{turn}\0{block}".encode(), hashlib.sha256).digest()
        for k in range(0, 32, 4):
            yield int.from_bytes(data[k:k + 4], "big")
        block += 1


def _script(text: str) -> str:
    for c in text:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
    return "latin"


def _letters(text: str, draw) -> str:
    """Same length and classes: lower, upper, digit; the rest stays."""
    alphabet = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчш",
                "greek": "αβγδεζηθικλμνξοπρστυφχψω"}[_script(text)]
    out = []
    for c in text:
        if c.isdigit():
            out.append("0123456789"[next(draw) % 10])
        elif c.isalpha():
            new = alphabet[next(draw) % len(alphabet)]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def surrogate(key: bytes, kind: str, entity: str, turn: int = 0) -> str:
    """Replacement of a canonical entity, itself canonical. The space of
    replacements grows with ``turn``; that of IPv4 addresses goes from 10/8 to
    the reserved 240/4, that of cards is beyond any corpus as it is."""
    draw = _stream(key, kind, entity, turn)
    more = max(0, turn - GROW + 1)
    if kind == "email":
        local, _, domain = entity.partition("@")
        local = _letters(local, draw) if len(local) >= 6 else _letters(local + "xxxxxx"[len(local):], draw)
        labels = domain.split(".")
        local += _letters("x" * more, draw)
        return f"{local}@{'.'.join(_letters(x, draw) for x in labels[:-1])}.example"
    if kind == "ip":
        return (f"{next(draw) % 15 + 240}." if more else "10.") + ".".join(str(next(draw) % 254 + 1) for _ in range(3))
    if kind in ("card", "phone"):
        keep = 1
        body = entity[:keep] + _letters(entity[keep:], draw)
        if kind == "card":
            wanted = luhn(entity)
            body = next((body[:-1] + d for d in "0123456789" if luhn(body[:-1] + d)), body) if wanted else (
                body if not luhn(body) else body[:-1] + str((int(body[-1]) + 1) % 10))
        return body + (_letters("0" * more, draw) if kind == "phone" else "")
    if kind.startswith("name"):
        script, gender = _script(entity), kind.partition(":")[2]
        first = NAMES[script][gender].split()
        syllables = FAMILY[script].split()
        family = "".join(syllables[next(draw) % len(syllables)] for _ in range(3 + turn)) + _ENDS[script]
        parts = entity.split(" ")
        return (f"{first[next(draw) % len(first)]} {family}" if len(parts) > 1 else family).casefold()
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", entity):
        digits = "0123456789ABCDEF" if entity.isupper() else "0123456789abcdef"
        return "".join(digits[next(draw) % 16] for _ in range(len(entity) + more))
    return _letters(entity + "x" * more, draw)


def render(kind: str, mention: str, new: str) -> str:
    """The canonical replacement in the layout of the mention."""
    if kind in ("card", "phone"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in mention) + "".join(digits)
    if kind.startswith("name"):
        words = [w[:1].upper() + w[1:] for w in new.split(" ")]
        return " ".join(words).upper() if mention.isupper() else " ".join(words)
    if kind == "email" and mention.isupper():
        return new.upper()
    return new


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """``kind, entity, n``: the distinct entities and their mentions. Counted per
    batch first, so that an entity in every document is one row per batch."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[tuple[str, str], int] = {}
        for value in batch["text"].to_pylist():
            for _, _, kind, mention in find(value) if value else ():
                k = kind, canonical(kind, mention)
                counts[k] = counts.get(k, 0) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], ["kind", "entity", "n"])

    found = map_texts(docs.select(F.col(text).alias("text")), "text",
                      "kind string, entity string, n long", run)
    return found.groupBy("kind", "entity").agg(F.sum("n").alias("n"))


def _with_surrogates(table: DataFrame, key: bytes) -> DataFrame:
    def run(it):
        for batch in it:
            new = [surrogate(key, k, e, t) for k, e, t in zip(
                batch["kind"].to_pylist(), batch["entity"].to_pylist(), batch["turn"].to_pylist(), strict=True)]
            yield batch.append_column("new", pa.array(new, pa.string()))

    return table.mapInArrow(run, "kind string, entity string, turn int, new string")


def assign(found: DataFrame, key: bytes, files: int | None = None) -> DataFrame:
    """``kind, entity, turn, new`` with distinct replacements.

    In each round the replacements of the table are compared with each other
    and with all entities; the smallest entity of a conflict keeps its own
    unless it is a real one, the others take the next number. Ends when a round
    finds no conflict; the replacements to draw from become more with each
    number, so conflicts fall by orders of magnitude a round. Each round is stored in at
    most ``files`` files.
    """
    group = F.substring_index("kind", ":", 1)
    now = store(_with_surrogates(found.select("kind", "entity", F.lit(0).alias("turn")), key), files)
    real = found.select(group.alias("g"), F.col("entity").alias("new")).distinct()
    while True:
        named = now.withColumn("g", group)
        keeps = named.groupBy("g", "new").agg(
            F.min(F.struct("entity", "kind")).alias("first"), F.count("*").alias("n"))
        shared = keeps.filter("n > 1").select("g", "new", "first")
        lost = named.join(shared, ["g", "new"]).filter(
            (F.col("entity") != F.col("first.entity")) | (F.col("kind") != F.col("first.kind")))
        clash = lost.select("kind", "entity").union(
            named.join(real, ["g", "new"], "left_semi").select("kind", "entity")).distinct()
        clash = store(clash, files)
        if not clash.limit(1).count():
            return now
        again = now.join(clash, ["kind", "entity"], "left_semi").select(
            "kind", "entity", (F.col("turn") + 1).alias("turn"))
        now = store(now.join(clash, ["kind", "entity"], "left_anti").unionByName(
            _with_surrogates(again, key)), files)


def replace(text: str | None, key: bytes,
            turn: Callable[[str, str], int]) -> tuple[str | None, int]:
    """The text with its entities replaced, and their number."""
    spans = find(text) if text else []
    if not spans:
        return text, 0
    out, at = [], 0
    for a, b, kind, mention in spans:
        entity = canonical(kind, mention)
        out += [text[at:a], render(kind, mention, surrogate(key, kind, entity, turn(kind, entity)))]
        at = b
    return "".join(out) + text[at:], len(spans)


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text",
                 count: str | None = None) -> DataFrame:
    """The documents with surrogates in ``text``; with ``count``, a column of that
    name with the number of entities is added (underscores if it exists).

    NULL stays NULL; texts without entities are returned as they are; all other
    columns stay; repeated rows are treated alike. No rows: no rows.
    """
    files = few_files(docs, text)
    mapping = assign(store(entities(docs, text), files), key, files)
    moved = store(mapping.filter("turn > 0").select("kind", "entity", "turn"), files)
    small = moved.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    extra = free_name(docs, "_turns")
    name = free_name(docs, count) if count else None
    columns = list(docs.columns)
    schema = list(docs.schema.fields)
    if small:
        table = {(r["kind"], r["entity"]): r["turn"] for r in moved.collect()}
        shared = docs.sparkSession.sparkContext.broadcast(table)
        rows = docs
    else:
        shared, rows = None, _with_turns(docs, moved, text, extra)
    if name:
        schema.append(StructField(name, LongType()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch[extra].to_pylist() if shared is None else [None] * len(batch)
        texts, counts = [], []
        for value, turns in zip(batch[text].to_pylist(), own, strict=True):
            table = shared.value if shared is not None else {
                (t["kind"], t["entity"]): t["turn"] for t in turns or ()}
            new, n = replace(value, key, lambda k, e, table=table: table.get((k, e), 0))
            texts.append(new)
            counts.append(n)
        made = [pa.array(texts, pa.string()) if c == text else batch[c] for c in columns]
        if name:
            made.append(pa.array(counts, pa.int64()))
        return pa.RecordBatch.from_arrays(made, [f.name for f in schema])

    return map_texts(rows, text, StructType(schema), run)


def _with_turns(docs: DataFrame, moved: DataFrame, text: str, extra: str) -> DataFrame:
    """Give each text the numbers of its own renumbered entities, by a join on
    the text's digest. The list of a text is bounded by its length."""
    digest = free_name(docs, "_digest")
    keyed = docs.withColumn(digest, F.sha2(F.col(text), 256))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(d, kind, canonical(kind, mention)) for d, value in zip(
            batch["digest"].to_pylist(), batch["text"].to_pylist(), strict=True)
            for _, _, kind, mention in (find(value) if value else ())]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.string()) for k in range(3)], ["digest", "kind", "entity"])

    pairs = map_texts(keyed.select(F.col(digest).alias("digest"), F.col(text).alias("text")), "text",
                      "digest string, kind string, entity string", run).distinct()
    turns = pairs.join(moved, ["kind", "entity"]).groupBy("digest").agg(
        F.collect_list(F.struct("kind", "entity", "turn")).alias(extra))
    kind = ArrayType(StructType([StructField("kind", StringType()), StructField("entity", StringType()),
                                 StructField("turn", IntegerType())]))
    return keyed.join(turns.withColumnRenamed("digest", digest), digest, "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(extra).cast(kind).alias(extra))
