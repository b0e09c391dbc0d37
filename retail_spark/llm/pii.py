"""Surrogates for personal data: found, replaced consistently, told apart.

Entities are found by patterns (e-mail, telephone, card and account numbers,
network addresses, secrets, names after a title or introduction). Every
distinct entity gets a surrogate drawn with a keyed hash, of the same type,
format, script and, for names, gender. Surrogates are checked against one
another and against the entities of the corpus; those in conflict are drawn
again, so different entities stay different, the same entity is replaced alike
in every document, and no replacement is itself an entity of the corpus.

Texts are read once to find entities; only texts that hold one are shuffled,
to meet their replacements.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from retail_spark.llm.common import free_name, stash

#: Given names by gender and script, and family names by script, that surrogates are drawn from.
GIVEN = {
    ("f", "latin"): "Anna Clara Elena Emma Eva Irene Julia Laura Lena Lucia Maria Marta Nina Nora Olga Paula Rosa Sara Sofia Vera".split(),
    ("m", "latin"): "Adam Bruno Carl David Emil Erik Felix Hugo Ivan Jonas Leo Luis Marco Martin Oscar Paul Pedro Simon Tomas Viktor".split(),
    ("f", "cyrillic"): "Анна Вера Елена Ирина Лидия Мария Нина Ольга Софья Татьяна".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Денис Иван Максим Олег Павел Роман Юрий".split(),
    ("f", "greek"): "Άννα Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("m", "greek"): "Αλέξης Γιάννης Δημήτρης Κώστας Μιχάλης Νίκος Πέτρος Σπύρος".split(),
}
FAMILY = {
    "latin": "Adler Alder Berger Blanco Castle Dumont Ebner Farrow Fischer Garnier Harper Iglesias Jansen Keller Lambert Moreno Novak Olsen Petit "
             "Quinn Romero Schubert Torres Ulrich Vidal Weber Winter Yates Ziegler".split(),
    "cyrillic": "Белов Волков Громов Зайцев Козлов Лебедев Морозов Новиков Орлов Соколов".split(),
    "greek": "Αγγελής Βασιλείου Γεωργίου Δήμου Ιωάννου Κόκκινος Λάμπρου Μάρκου Νικολάου Παππάς".split(),
}
#: Titles and introductions before a name, with the gender they show.
TITLES = {"Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f",
          "Mme": "f", "Señora": "f", "Sra": "f", "Dr": "", "Prof": "", "г-н": "m", "г-жа": "f", "κύριος": "m", "κυρία": "f"}
INTRODUCTIONS = ("my name is", "je m'appelle", "ich heiße", "mein Name ist", "me llamo", "mi nombre es", "меня зовут", "με λένε")
INTRODUCTIONS += tuple(x[0].upper() + x[1:] for x in INTRODUCTIONS if x[0].islower())

_REST = r"[\w'’-]*[^\W\d_]"
_UPPER = "A-ZÀ-ÖØ-ÞĀ-ŽΆ-ΫА-ЯЁ"
_WORD = rf"[{_UPPER}]{_REST}"
#: Words inside a name that are no name themselves.
PARTICLES = "al bin da das de del della den der di do dos du el la las le los ten ter van von y zu".split()
#: In order of precedence where matches start at the same place or overlap.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]*[A-Za-z0-9_%+\-]@[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{32}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "card": r"(?<![0-9A-Za-z\-])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,5}\)[ .\-]?)?[0-9]{2,5}(?:[ .\-]?[0-9]{2,5}){1,4}"
             r"|\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?![0-9A-Za-z])",
    "name": rf"(?:(?<!\w)(?P<title>{'|'.join(map(re.escape, TITLES))})\.?|(?<!\w)(?:{'|'.join(map(re.escape, INTRODUCTIONS))}))"
            rf"[ \t]+(?P<person>(?:(?:[{_UPPER}]\.|{_WORD}|[{_UPPER}]|{'|'.join(PARTICLES)})[ \t]+)*{_WORD})",
}
#: A text without any of these holds no entity.
def _first(words) -> str:
    """A class of the words' first letters and the choice of what follows, which Java tries at few places."""
    return f"[{''.join(sorted({w[0] for w in words}))}](?:{'|'.join(re.escape(w[1:]) for w in words)})"


HINT = "|".join(["[@0-9]", "AKIA[A-Z]", "gh[pousr]_", "sk-[A-Za-z]", "[a-f]{32}", _first(TITLES) + r"\.?[ \t]", _first(INTRODUCTIONS)])

ENTITIES = "array<struct<start:int,stop:int,kind:string,value:string,hint:string>>"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _script(word: str) -> str:
    c = next((c for c in word if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


class Finder:
    """Finds entities: (start, stop, kind, value, hint), in text order and apart from one another.

    ``value`` is what makes two mentions the same entity (e-mail addresses
    without case, numbers without separators); the words of a name are
    entities of their own, so a full name and a later mention of the family
    name alone agree, with or without a title; particles stay. ``hint`` is a given name's gender, if the title or the
    name itself shows one.
    """

    def __init__(self):
        self.patterns = [(kind, re.compile(p)) for kind, p in PATTERNS.items()]
        self.genders = {w.lower(): g for (g, _), ws in GIVEN.items() for w in ws}

    def __call__(self, text: str | None) -> list[tuple]:
        if not text:
            return []
        found, digits = [], any(c in text for c in "0123456789")
        for order, (kind, pattern) in enumerate(self.patterns):
            if kind == "email" and "@" not in text or kind not in ("email", "name", "secret") and not digits:
                continue
            for m in pattern.finditer(text):
                span = m.span("person") if kind == "name" else m.span()
                found.append((span[0], order, span[1], kind, m))
        out, end = [], -1
        for start, _, stop, kind, m in sorted(found, key=lambda x: x[:3]):
            if start < end:
                continue
            raw, hint = text[start:stop], ""
            if kind == "email":
                value = raw.lower()
            elif kind in ("card", "phone", "ssn"):
                value = re.sub(r"[^0-9]", "", raw)
            elif kind == "iban":
                value = raw.replace(" ", "")
            elif kind == "name":
                words = [w for w in re.finditer(r"\S+", raw) if w[0] not in PARTICLES]
                hint = TITLES.get(m["title"] or "", "") or self.genders.get(words[0][0].lower(), "")
                for k, w in enumerate(words):
                    family = k == len(words) - 1 and (k or m["title"])
                    out.append((start + w.start(), start + w.end(), "family" if family else "given", w[0], "" if family else hint))
                end = stop
                continue
            else:
                value = raw
            out.append((start, stop, kind, value, hint))
            end = stop
        return self._mentions(text, out)

    @staticmethod
    def _mentions(text: str, found: list[tuple]) -> list[tuple]:
        """``found`` and the whole-word mentions of its names elsewhere in the text; a family name goes before a given one."""
        names = {}
        for _, _, kind, value, hint in found:
            if kind == "family" or kind == "given" and len(value.rstrip(".")) > 1 and names.get(value.lower(), ("",))[0] != "family":
                names[value.lower()] = (kind, hint, value)
        if not names:
            return found
        # one pass over the words, however many names there are
        out, spans, k = list(found), [(x[0], x[1]) for x in found], 0
        for m in re.finditer(rf"(?<![\w'’-]){_WORD}(?![\w-])", text):
            for start, stop, value in _named(m, names):
                while k < len(spans) and spans[k][1] <= start:
                    k += 1
                if k == len(spans) or stop <= spans[k][0]:
                    out.append((start, stop, names[value][0], names[value][2], names[value][1]))
        return sorted(out)


def _named(m: re.Match, names: dict) -> list[tuple[int, int, str]]:
    """The name in small letters that the word ``m`` is, as a whole or before an apostrophe: [(start, stop, name)] or []."""
    for word in (m[0], re.split("['’]", m[0])[0]):
        if word.lower() in names:
            return [(m.start(), m.start() + len(word), word.lower())]
    return []


class Surrogates:
    """Draws surrogates: attempt k of an entity always gives the same value for a key."""

    def __init__(self, key: bytes):
        self.key = key

    def draw(self, kind: str, value: str, hint: str, attempt: int) -> str:
        number = int.from_bytes(hmac.new(self.key, f"{kind}\0{value}\0{attempt}".encode(), hashlib.sha512).digest(), "big")

        def take(n: int) -> int:
            nonlocal number
            number, r = divmod(number, n)
            if number < n:
                number = int.from_bytes(hashlib.sha512(number.to_bytes(64, "big") + self.key).digest(), "big")
            return r

        if kind == "email":
            name, _, host = value.partition("@")
            labels = host.split(".")
            shape = "".join(self._like(c, take) for c in name)
            return f"{shape}@" + ".".join([*("".join(self._like(c, take) for c in x) for x in labels[:-1]), labels[-1]])
        if kind == "ip":
            return ".".join(str((10, 172, 192)[take(3)] if k == 0 else take(256)) for k in range(4))
        if kind == "card":
            body = [str(1 + take(9)), *(str(take(10)) for _ in value[1:-1])]
            valid = _luhn(value)
            for d in sorted(range(10), key=lambda d, r=take(10): (d - r) % 10):
                if _luhn("".join(body) + str(d)) == valid:
                    return "".join(body) + str(d)
        if kind in ("given", "family"):
            script = _script(value)
            names = FAMILY[script] if kind == "family" else GIVEN[(hint or "fm"[take(2)], script)]
            # after some draws the lists may be used up: names of two and more parts
            return "-".join(names[take(len(names))] for _ in range(1 + attempt // 4))
        return "".join(self._like(c, take) for c in value)

    @staticmethod
    def _like(c: str, take) -> str:
        if c in "0123456789":
            return str(take(10))
        if "a" <= c <= "f":
            return "abcdef"[take(6)]
        if "a" <= c <= "z":
            return chr(97 + take(26))
        if "A" <= c <= "Z":
            return chr(65 + take(26))
        return c

    @staticmethod
    def shaped(kind: str, raw: str, surrogate: str) -> str:
        """The surrogate with the separators and capitals of a mention."""
        if kind in ("card", "phone", "ssn", "iban"):
            left = iter(surrogate)
            return "".join(next(left, "") if c.isalnum() else c for c in raw)
        if kind == "email" and raw.isupper():
            return surrogate.upper()
        if kind in ("given", "family") and len(raw.rstrip(".")) > 1 and raw.isupper():
            return surrogate.upper()
        return surrogate


def find(docs: DataFrame) -> DataFrame:
    """(doc, row, entities) of the rows of ``docs(doc, row, text)`` that hold an entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("value", pa.string()), ("hint", pa.string())]))
        keys = ("start", "stop", "kind", "value", "hint")
        for batch in batches:
            docs, rows, found = [], [], []
            for d, r, t in zip(*(c.to_pylist() for c in batch.columns)):
                if e := finder(t):
                    docs.append(d)
                    rows.append(r)
                    found.append([dict(zip(keys, x)) for x in e])
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(rows, pa.int64()), pa.array(found, kind)],
                                              names=["doc", "row", "entities"])

    return docs.filter(F.col("text").rlike(HINT)).mapInArrow(run, f"doc bigint, row bigint, entities {ENTITIES}")


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) for ``entities(kind, value, hint)``, every surrogate used once.

    Each round draws for the entities still without one. A draw is good if no
    entity of the corpus is written like it, capitals apart, whatever its kind,
    if it is not given out, and if of those that drew the same it belongs to the
    smallest kind and value. The rest draws again.
    """
    distinct = stash(entities.groupBy("kind", "value").agg(F.max("hint").alias("hint")), "entities")
    same = F.lower("surrogate").alias("written")
    known = distinct.select(F.lower("value").alias("written")).distinct()
    todo, done, attempt = distinct, None, 0
    while True:
        draw = F.udf(lambda kind, value, hint, k=attempt: Surrogates(key).draw(kind, value, hint, k), useArrow=True)
        drawn = todo.withColumn("surrogate", draw("kind", "value", "hint")).withColumn("written", same)
        drawn = stash(drawn.join(known, "written", "left_anti"), "drawn")
        if done is not None:
            drawn = drawn.join(done.select(same), "written", "left_anti")
        first = drawn.groupBy("written").agg(F.min(F.struct("kind", "value", "surrogate")).alias("s"))
        good = stash(first.select("s.kind", "s.value", "s.surrogate"), "surrogates")
        done = good if done is None else done.union(good)
        todo = stash(todo.join(good, ["kind", "value"], "left_anti"), "entities")
        if not todo.take(1):
            return done
        attempt += 1


def deidentify(docs: DataFrame, *, key: bytes = b"surrogate key") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, plus a last column ``n_replaced``.

    Null and empty texts, and texts without an entity, stay as they are
    (n_replaced 0). Other columns are kept; a column named like the new one
    makes the new one's name grow underscores. Repeated rows are replaced
    alike. An empty table gives an empty result. Whole texts are searched.
    """
    count = free_name(docs, "n_replaced")
    key_row, key_doc = free_name(docs, "pii_row"), free_name(docs, "pii_doc")
    doc, row = F.col("doc_id").cast("bigint"), F.xxhash64("text")
    found = stash(find(docs.select(doc.alias("doc"), row.alias("row"), "text")).dropDuplicates(["doc", "row"]), "found")
    spans_name = free_name(docs, "pii_spans")
    mention = found.select("doc", "row", F.explode("entities").alias("e")).select("doc", "row", "e.*")
    # capitals are a matter of the mention: a name is one entity however it is written
    mention = mention.withColumn("value", F.when(F.col("kind").isin("given", "family"), F.lower("value")).otherwise(F.col("value")))
    chosen = surrogates(mention.select("kind", "value", "hint"), key)
    # a value of many texts: Spark splits the partition of its mentions
    spans = (mention.join(chosen, ["kind", "value"]).groupBy("doc", "row")
             .agg(F.sort_array(F.collect_list(F.struct("start", "stop", "kind", "surrogate"))).alias("spans"))
             .select(F.col("doc").alias(key_doc), F.col("row").alias(key_row), F.col("spans").alias(spans_name)))
    names, some = docs.columns, F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    quiet = docs.filter(~some).select(*names, F.lit(0).alias(count))
    rest = docs.filter(some).join(spans, doc.eqNullSafe(F.col(key_doc)) & (row == F.col(key_row)), "left")
    given = F.col(spans_name)
    new = F.when(given.isNull(), F.col("text")).otherwise(_replace(F.col("text"), given))
    rest = rest.select(*[new.alias("text") if c == "text" else F.col(c) for c in names],
                       F.when(given.isNull(), 0).otherwise(F.size(given)).alias(count))
    return quiet.unionByName(rest)


def replaced(docs: DataFrame, *, key: bytes = b"surrogate key") -> DataFrame:
    """``docs`` with its own columns only; ``n_chars``, if there is one, follows a changed text."""
    count = free_name(docs, "n_replaced")
    out = deidentify(docs, key=key)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(count) > 0, F.char_length("text")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@F.udf(returnType=StringType(), useArrow=True)
def _replace(text, spans):
    if text is None or spans is None:
        return text
    out, at = [], 0
    for start, stop, kind, surrogate in spans:
        out += [text[at:start], Surrogates.shaped(kind, text[start:stop], surrogate)]
        at = stop
    return "".join([*out, text[at:]])
