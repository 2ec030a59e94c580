"""Personal data replaced by keyed surrogates of the same type and format.

Entities: e-mail addresses, telephone numbers, IPv4 addresses, payment card
numbers, secrets in hexadecimal, and names after a title. An entity's canonical
form (digits of a number, lower-case address, one name token) is mapped by a
keyed permutation over all strings of its format: a Feistel network on the
numerals of its characters, keyed by HMAC with type, format and key. A
permutation gives different entities different surrogates without any table, and
equal ones equal surrogates everywhere (coreference); the format (punctuation,
case, length, script, Luhn check of cards, address ranges of IPs, gender of
given names) is put back at each mention.

Collision check: the distinct entities of the table and their surrogates are
compared by joins; an entity whose surrogate is itself an entity, or is also
another's, is drawn again with the next tweaks until none is left. Such redrawn
entities go back to the documents that mention them by joins. Names are hashed,
not permuted; redrawn ones get more syllables, so their space never ends. Another
format's space can: more entities than it has free strings raise an error.

Defined results: null text stays null, empty stays empty; text without entities
is returned unchanged; repeated rows change alike; an empty table gives no rows;
other columns pass through, but for ``n_entities`` and ``entity_types``, which
replace columns of that name.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.llm.common import let_go, stored, unused_name

ROUNDS = 8
# Titles before names, by the gender they tell.
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "г-н": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "г-жа": "f"}
# Syllables that build surrogate name tokens, by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo za ze zo".split(),
    "cyrillic": "ба бо ва во га го да до за зо ка ко ла ло ма мо на но па по ра ро са со та то".split(),
}
# Endings that make a given name read as a man's or a woman's.
ENDINGS = {("latin", "m"): ["n", "s", "r"], ("latin", "f"): ["a", "ia", "ina"], ("cyrillic", "m"): ["н", "р", "с"], ("cyrillic", "f"): ["а", "ия", "на"],
           ("latin", ""): ["ner", "son", "well"], ("cyrillic", ""): ["ов", "ин", "енко"]}

_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])[\w.+-]*\w@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])")),
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)"
                         r"|(?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-])")),
    ("card", re.compile(r"(?<![\w.])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!\w)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("name", re.compile(rf"(?<!\w)(?:{_TITLE})\.? [^\W\d_a-z]\w+(?: [^\W\d_a-z]\w+)?(?!\w)")),
]
#: A text can only hold an entity if it has one of these.
MAY = re.compile(rf"[@]|\d|[0-9a-fA-F]{{32}}|(?:{_TITLE})")


def _number(key: bytes, kind: str, label: str, modulus: int) -> int:
    n = (modulus.bit_length() + 64 + 7) // 8
    raw = b"".join(hmac.new(key, f"{kind}\0{i}\0{label}".encode(), hashlib.sha256).digest() for i in range(-(-n // 32)))
    return int.from_bytes(raw[:n], "big") % modulus


def permuted(numerals: list[int], radices: list[int], key: bytes, kind: str) -> list[int]:
    """Keyed bijection on numeral strings of these radices: alternating modular
    additions of each half's image to the other."""
    half = (len(numerals) + 1) // 2
    parts = [(numerals[:half], radices[:half]), (numerals[half:], radices[half:])]

    def pack(digits: list[int], bases: list[int]) -> tuple[int, int]:
        value, size = 0, 1
        for d, r in zip(digits, bases):
            value, size = value * r + d, size * r
        return value, size

    (a, na), (b, nb) = (pack(*p) for p in parts)
    form = ",".join(map(str, radices))
    for i in range(ROUNDS):
        if i % 2:
            b = (b + _number(key, kind, f"{form}\0{i}\0{a}", nb)) % nb
        else:
            a = (a + _number(key, kind, f"{form}\0{i}\0{b}", na)) % na
    out: list[int] = []
    for value, bases in ((a, parts[0][1]), (b, parts[1][1])):
        digits = []
        for r in reversed(bases):
            value, d = divmod(value, r)
            digits.append(d)
        out += reversed(digits)
    return out


ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "éèêëàâäîïôöûüùçñßóíáú"]


def _characters(text: str, key: bytes, kind: str) -> str:
    """Permutes letters and digits inside their alphabets; others stay."""
    at = [(i, next((a for a in ALPHABETS if c in a), "")) for i, c in enumerate(text)]
    at = [(i, a) for i, a in at if a]
    if not at:
        return text
    out = list(text)
    for (i, a), d in zip(at, permuted([a.index(text[i]) for i, a in at], [len(a) for _, a in at], key, kind)):
        out[i] = a[d]
    return "".join(out)


def luhn(digits: str) -> int:
    """Luhn sum modulo 10; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _name_token(token: str, kind: str, key: bytes, tweak: int) -> str:
    script = "cyrillic" if re.search("[а-яё]", token) else "latin"
    gender = kind[-1] if kind in ("given_m", "given_f") else ""
    parts = SYLLABLES[script]
    n = 2 + (len(token) > 5) + tweak.bit_length()
    value = _number(key, kind + (f"#{tweak}" if tweak else ""), token, len(parts) ** n * 3)
    value, end = divmod(value, 3)
    made = ""
    for _ in range(n):
        value, d = divmod(value, len(parts))
        made += parts[d]
    return made + ENDINGS[script, gender][end]


def surrogate(kind: str, canonical: str, key: bytes, tweak: int = 0) -> str:
    """The surrogate's canonical form."""
    t = f"#{tweak}" if tweak else ""
    if kind == "email":
        local, host = canonical.split("@", 1)
        labels = host.split(".")
        return _characters(local, key, "local" + t) + "@" + ".".join([*(_characters(x, key, "host" + t) for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        private = canonical.split(".")[0] in ("10", "127", "0")
        parts = [int(x) for x in canonical.split(".")]
        fixed = 1 if private else 2 if canonical.startswith(("192.168.", "169.254.")) else 0
        return ".".join(map(str, parts[:fixed] + permuted(parts[fixed:], [256] * (4 - fixed), key, "ip" + t)))
    if kind == "card":
        body = "".join(map(str, permuted([int(c) for c in canonical[:-1]], [10] * (len(canonical) - 1), key, "card" + t)))
        want = luhn(canonical)
        return next(body + str(c) for c in range(10) if luhn(body + str(c)) == want)
    if kind == "secret":
        return "".join("0123456789abcdef"[d] for d in permuted([int(c, 16) for c in canonical], [16] * len(canonical), key, "secret" + t))
    if kind in ("given_m", "given_f", "surname"):
        return _name_token(canonical, kind, key, tweak)
    keep = canonical.index("/") + 1 if "/" in canonical else 0      # country code
    digits = canonical[keep:]
    return canonical[:keep] + "".join(map(str, permuted([int(c) for c in digits], [10] * len(digits), key, kind + t)))


_NAMES = ("given_m", "given_f", "surname")


def space(kind: str, canonical: str) -> tuple[str, int] | None:
    """The form whose strings can be surrogates of a redrawn entity, and how
    many there are; None for names, which have no end of them."""
    if kind in _NAMES:
        return None
    if kind == "email":
        head, tld = canonical.rsplit(".", 1)
        at = [next((k for k, a in enumerate(ALPHABETS) if c in a), -1) for c in head]
        return "".join(c if k < 0 else "0aа\u00e9"[k] for c, k in zip(head, at)) + "." + tld, prod(len(ALPHABETS[k]) for k in at if k >= 0)
    if kind == "ip":
        parts = canonical.split(".")
        if parts[0] in ("10", "127", "0"):
            return parts[0], 256 ** 3
        if canonical.startswith(("192.168.", "169.254.")):
            return ".".join(parts[:2]), 256 ** 2
        return "", 256 ** 4 - 3 * 256 ** 3 - 2 * 256 ** 2
    if kind == "card":
        return f"{len(canonical)} {luhn(canonical)}", 10 ** (len(canonical) - 1)
    if kind == "secret":
        return str(len(canonical)), 16 ** len(canonical)
    code, _, digits = canonical.rpartition("/")
    return f"{code}/{len(digits)}", 10 ** len(digits)


def entities(text: str) -> list[tuple[int, int, list[tuple[int, int, str, str]]]]:
    """Spans of entities, left to right and apart; each with its parts: (start,
    end, kind, canonical form). Where patterns overlap, the earlier pattern of
    the list has it."""
    if not MAY.search(text):
        return []
    taken: list[tuple[int, int, str]] = []
    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text):
            a, b = m.span()
            if all(b <= x or a >= y for x, y, _ in taken):
                taken.append((a, b, kind))
    out = []
    for a, b, kind in sorted(taken):
        said = text[a:b]
        if kind == "name":
            words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"\S+", said)]
            gender = TITLES[words[0][2].rstrip(".")]
            parts = [(a + s, a + e, "surname" if i == len(words) - 1 else f"given_{gender}", w.lower()) for i, (s, e, w) in enumerate(words) if i]
        elif kind == "email":
            parts = [(a, b, kind, said.lower())]
        elif kind == "phone":
            code = re.match(r"\+(\d{1,3})(?=[ .(-])", said)
            digits = re.sub(r"\D", "", said[code.end():] if code else said)
            # the national number alone is the same telephone with or without +1
            parts = [(a, b, kind, (f"{code.group(1)}/" if code and code.group(1) != "1" else "") + digits)]
        elif kind in ("card", "ssn"):
            parts = [(a, b, kind, re.sub(r"\D", "", said))]
        elif kind == "ip":
            parts = [(a, b, kind, ".".join(str(int(x)) for x in said.split(".")))]
        else:
            parts = [(a, b, kind, said.lower())]
        out.append((a, b, parts))
    return out


def rendered(said: str, kind: str, made: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("phone", "card", "ssn"):
        code = re.match(r"\+\d{1,3}(?=[ .(-])", said) if kind == "phone" else None
        digits = iter(made.split("/")[-1])
        head = code.end() if code else 0
        return said[:head] + "".join(next(digits) if c.isdigit() else c for c in said[head:])
    if kind == "ip":
        return made
    if kind in ("given_m", "given_f", "surname"):
        return made.upper() if said.isupper() else made.capitalize()
    return "".join(m.upper() if c.isupper() else m for c, m in zip(said, made))


def replaced(text: str, key: bytes, tweaks: dict[tuple[str, str], int]) -> tuple[str, list[str]]:
    out, at, kinds = [], 0, []
    for _, _, parts in entities(text):
        for a, b, kind, canonical in parts:
            made = surrogate(kind, canonical, key, tweaks.get((kind, canonical), 0))
            out += [text[at:a], rendered(text[a:b], kind, made)]
            at = b
            kinds.append(kind)
    return "".join([*out, text[at:]]), kinds


def _mapped(texts: DataFrame, fn: Callable[[str | None, list | None], list[tuple]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            rows = [r for t in batch.column(0).to_pylist() if t for r in fn(t, None)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(len(names))], names)

    return texts.mapInArrow(run, schema)


def _taken(rows: DataFrame, column: str) -> DataFrame:
    """(kind, form, size, n): how many of the strings in ``column`` each form has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, *s) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (s := space(k, v))]
            kinds, forms, sizes = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(forms, pa.string()),
                                              pa.array([min(n, 1 << 62) for n in sizes], pa.int64())], ["kind", "form", "size"])

    return (rows.select("kind", column).mapInArrow(run, "kind string, form string, size long")
            .groupBy("kind", "form", "size").agg(F.count(F.lit(1)).alias("n")))


def _require_room(known: DataFrame, kept: DataFrame, open_: DataFrame) -> None:
    """Raises if a form has fewer free strings than entities still to be drawn."""
    wanted = _taken(open_, "value").withColumnRenamed("n", "wanted")
    used = _taken(known.select("kind", F.col("value").alias("made")).unionByName(kept.select("kind", "made")).distinct(), "made")
    short = wanted.join(used, ["kind", "form", "size"], "left").where(F.col("wanted") > F.col("size") - F.coalesce("n", F.lit(0))).take(1)
    if short:
        r = short[0]
        raise ValueError(f"no surrogates left for {r.kind} of form {r.form!r}: {r.size} strings, {r.n} taken, {r.wanted} more wanted")


def redrawn(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """(kind, value, tweak) of entities whose first surrogates collide with an
    entity or with another surrogate; usually none. All surrogates differ in the
    end; an error tells where a form has too few strings for that."""
    def found(text: str, _: None) -> list[tuple]:
        return [(k, v) for _, _, parts in entities(text) for _, _, k, v in parts]

    known = stored(_mapped(docs.select(F.col(text_col).cast("string").alias("text")), found, "kind string, value string").distinct(), "entities")

    def drawn(rows: DataFrame, tweaks: range) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds, values = batch.column("kind").to_pylist(), batch.column("value").to_pylist()
                for tweak in tweaks:
                    made = []
                    for k, v in zip(kinds, values):
                        new = surrogate(k, v, key, tweak)
                        made.append(new if not tweak or k in _NAMES or space(k, new) == space(k, v) else None)
                    yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("value"), pa.array(made, pa.string()),
                                                      pa.array([tweak] * len(made), pa.int32())], ["kind", "value", "made", "tweak"])

        return rows.select("kind", "value").mapInArrow(run, "kind string, value string, made string, tweak int").where("made is not null")

    def apart(rows: DataFrame) -> DataFrame:
        """Of several entities with one surrogate the smallest keeps it; none is an entity."""
        free = rows.join(known.select("kind", F.col("value").alias("made")), ["kind", "made"], "left_anti")
        return free.groupBy("kind", "made").agg(F.min(F.struct("value", "tweak")).alias("one")).select("kind", "one.value", "made", "one.tweak")

    first = stored(apart(drawn(known, range(1))), "surrogates-0")
    open_ = stored(known.join(first, ["kind", "value"], "left_anti"), "clash-0")
    moved, tweak, width = stored(first.limit(0), "redrawn-0"), 1, 1
    while open_.take(1):
        # a few tweaks singly, then more and more at once: a crowded form needs many
        if tweak > 2:
            _require_room(known, first.unionByName(moved), open_)
            width *= 2
        tries = drawn(open_, range(tweak, tweak + width))
        tries = tries.join(first.unionByName(moved).select("kind", "made"), ["kind", "made"], "left_anti")
        # the smallest entity has a surrogate, and each entity the first of those it has
        new = apart(tries).groupBy("kind", "value").agg(F.min(F.struct("tweak", "made")).alias("one")).select("kind", "value", "one.made", "one.tweak")
        moved = stored(moved.unionByName(new), f"redrawn-{tweak}")
        open_ = stored(open_.join(moved, ["kind", "value"], "left_anti"), f"clash-{tweak}")
        tweak += width
    return moved.select("kind", "value", "tweak")


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", check: bool = True) -> DataFrame:
    """``docs`` with surrogates in ``text_col``, ``n_entities`` and ``entity_types``."""
    secret = key.encode()
    kept = [c for c in docs.columns if c not in ("n_entities", "entity_types")]
    rows = docs.select(*kept)
    tw_col, h_col = unused_name(docs, "_tweaks"), unused_name(docs, "_text_hash")
    tweaks = redrawn(docs, secret, text_col) if check else None
    if tweaks is not None and tweaks.take(1):
        # texts that mention redrawn entities get them by their hash
        def mentions(text: str, _: None) -> list[tuple]:
            h = hashlib.blake2b(text.encode(), digest_size=16).hexdigest()
            return [(h, k, v) for _, _, parts in entities(text) for _, _, k, v in parts]

        named = _mapped(docs.select(F.col(text_col).cast("string").alias("text")), mentions, "h string, kind string, value string").distinct()
        per_text = named.join(tweaks, ["kind", "value"]).groupBy("h").agg(F.collect_list(F.struct("kind", "value", "tweak")).alias(tw_col))
        rows = _hashed(rows, text_col, h_col).join(per_text.withColumnRenamed("h", h_col), h_col, "left").drop(h_col)
    else:
        rows = rows.withColumn(tw_col, F.lit(None).cast("array<struct<kind:string,value:string,tweak:int>>"))

    schema = rows.drop(tw_col).schema.add("n_entities", "long").add("entity_types", "string")
    place = [f.name for f in schema.fields].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts, counts, types = [], [], []
            for text, tw in zip(batch.column(text_col).to_pylist(), batch.column(tw_col).to_pylist()):
                new, kinds = replaced(text, secret, {(x["kind"], x["value"]): x["tweak"] for x in tw or ()}) if text else (text, [])
                texts.append(new)
                counts.append(len(kinds))
                types.append(",".join(sorted(set(kinds))))
            columns = [batch.column(f.name) for f in schema.fields[:-2]]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(types, pa.string())], [f.name for f in schema.fields])

    return rows.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def _hashed(rows: DataFrame, text_col: str, name: str) -> DataFrame:
    schema = rows.select("*").schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [hashlib.blake2b((t or "").encode(), digest_size=16).hexdigest() for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h, pa.string())], [f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)
