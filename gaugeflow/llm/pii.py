"""Personal data replaced by keyed surrogates.

Detected entities: e-mail addresses, IPv4 addresses, phone numbers (with a country
code after + or 00, with a leading 0, in North American form, or after a label such
as "Tel."), account and card numbers (13 to 19 digits), social security numbers,
IBANs, secrets (labelled ones of 6 characters or more, keys that begin with a known
prefix, and mixtures of 20 or more characters with three letters and three digits),
and person names after a title or a known given name. Phone numbers without any of
those signs are not told from other numbers and stay. An entity's surrogate follows from HMAC-SHA256 of its kind and
canonical form under a key, so every mention in every document gets the same one.
It keeps the kind and the format: letters, digits, case, length and punctuation,
country codes, check digits (valid stays valid), the script of a name, and its
gender (unknown stays unknown).

Collision checks over the whole corpus keep surrogates distinct: no two entities
of a kind share one, and none equals an entity that occurs. Who collides (all but
the smallest canonical form) draws again until nobody does. Draws beyond the first
are exceptions; documents that mention one are joined to them, all others need
nothing but the key. Late draws add letters to addresses and secrets, and draw the country
code of phone numbers too, as forms with few signs have few others.

Null and empty texts stay as they are. Rows are kept one to one with all their
columns; only text changes (and n_chars, if there is one, where text changed).

At scale: entities are made distinct before the shuffle, so an entity that stands
in a third of the documents is one row per task; documents are shuffled only if the
exceptions are too many to broadcast.
"""

from __future__ import annotations

import hashlib
import hmac
import os
import re
import secrets
import warnings

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm import text as T
from gaugeflow.llm.keyfilter import KeyFilter, build_filter
from gaugeflow.llm.features import per_row
from gaugeflow.llm.names import free_name
from gaugeflow.session import materialize

#: For tests and local runs; other sessions must give their own.
DEFAULT_KEY = "change-me"
#: Where a key is looked up, in this order. Spark's logs hide settings with this ending.
KEY_SETTING, KEY_VARIABLE = "spark.gaugeflow.pii.secret", "GAUGEFLOW_PII_KEY"
#: Keys drawn for applications that were given none, by application id. They stay on the driver.
_DRAWN: dict[str, str] = {}
#: Draws before giving up; each round settles all but a small share of the rest.
ROUNDS = 40

# Titles, given names and name parts.
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Signor".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Sra Señorita Signora".split(),
    "u": "Dr Prof Professor Doktor Docteur Doctor".split()}
GIVEN = {
    ("latin", "f"): """Mary Patricia Jennifer Elizabeth Barbara Susan Jessica Margaret Sophie Camille
        Charlotte Juliette Margaux Katharina Friederike Heike Brigitte Gisela Carmen Dolores Beatriz
        Guadalupe Francesca Giulia""".split(),
    ("latin", "m"): """James Robert Michael William Richard Thomas Christopher Matthew Pierre Jacques
        François Guillaume Hans Jürgen Wolfgang Friedrich Dieter Carlos Javier Alejandro Francisco
        Giovanni Lorenzo Patrick""".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана".split(),
    ("cyrillic", "m"): "Иван Сергей Дмитрий Алексей Николай Михаил Андрей Владимир".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Δήμητρα Γεωργία".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Νίκος Κώστας Παναγιώτης Βασίλης".split()}
PARTS = {
    "latin": "bar ben cor dal den fer gan hal kel lan len mar mor nel nor pal per ral ren sal sel tam ter val ven wal wen".split(),
    "cyrillic": "бар вел гор дем зар кор лаз мир нов пет род сав тар фед".split(),
    "greek": "βαρ γαλ δημ θαν καλ λαμ μαρ νικ παπ σαρ ταρ φιλ".split()}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
           "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@[\w-]+(?:\.[\w-]+)+")
IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d|[A-Za-z])")
# what may stand between the digit groups of a phone number; a group ends before a letter or is long
_GAP = r"(?:[-‐‑–./]|[ \t\xa0 ]{1,2}| [-–] | ?\(|\)[-./ \xa0]?)"
_MORE = rf"(?:{_GAP}(?:\d{{3,}}|\d+(?![^\W_])))"
PLUS = re.compile(rf"(?<![\w+])\+\(?\d+{_MORE}*")
# groups that other signs stand between, as junk does
PLUS_WIDE = re.compile(r"(?<![\w+])\+\d{1,3}[^\w\n]{1,8}\d{2,4}(?:[^\w\n]{1,8}\d{2,4}){2,}(?!\d)")
AMERICAN = re.compile(
    r"(?<![\w+])\(\d{3}\)[^\w\n]{0,8}\d{3}[-. ]\d{4}(?!\d)"
    r"|(?<![\w.-])(?:1[-. ])?(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}(?![\w-])")
# not dates such as 05/17/2023
TRUNK = re.compile(
    rf"(?<![\w.,+/-])(?!\d{{1,2}}([./-])\d{{1,2}}\1\d{{2,4}}(?!\d|\1\d))(?:\(0\d{{1,5}}\)|0\d{{1,5}}(?!\d)){_MORE}+"
    rf"|(?<![\w.,+/-])(?:\(0\d{{1,5}}\))\d{{3,}}{_MORE}*")
CALLED = re.compile(
    rf"(?i)(?<!\w)(?:tel|phone|telephone|telefone?|t[ée]l[ée]phone|tel[ée]fono|fax|mobile?|handy)"
    rf"(?: ?(?:no|nr|number))?\.?\s?[:=#]?\s?(\(?\d+{_MORE}*)")
# digits of a mention that stand for no part of the number: 00 before a country code, (0) after one
_IDLE = re.compile(r"^00(?=[1-9])|(?<=\d)\(0\)|(?<=\d[ \xa0])\(0\)")
# country codes of one and two digits; all others have three
CODE = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3}")
ACCOUNT = re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)")
SOCIAL = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_LABEL = r"(?:api[_-]?key|access[_-]?key|private[_-]?key|secret|token|password|passwd|pwd)[\"']?\s*[=:]"
LABELLED = re.compile(
    rf"(?i)(?<![^\W_]){_LABEL}\s*(?:\"([^\"\n]{{6,200}})\"|'([^'\n]{{6,200}})'|[\"']?([^\s\"']{{6,}}))")
# keys that services mark by a prefix; the prefix stays
_KEY_PREFIX = (r"AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|[spr]k_(?:live|test)_|xox[abeoprs]-|AIza|hf_|npm_"
               r"|ya29\.|eyJ")
KEY_PREFIX = re.compile(_KEY_PREFIX)
PREFIXED = re.compile(
    r"(?<![\w-])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)|(?:gh[pousr]_|github_pat_|glpat-|sk-|hf_|npm_)[\w-]{16,}"
    r"|(?:[spr]k_(?:live|test)_|xox[abeoprs]-)[\w-]{10,}|AIza[\w-]{30,}|ya29\.[\w-]{20,}"
    r"|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]*)", re.ASCII)
#: Rows that may hold a secret without a digit.
ANNOUNCED = rf"(?i:{_LABEL})|{_KEY_PREFIX}"
MIXED = re.compile(r"(?<![\w-])[A-Za-z0-9_-]{20,}(?![\w-])")
_UPPER = "A-ZÀ-ÖØ-ÞΑ-ΩΆ-ΏЀ-Я"
_LOWER = "a-zß-öø-ÿα-ωά-ώа-ѿ"
# Thornbury, O'Neil, Smith-Jones, THORNBURY
_NAME = (rf"[{_UPPER}](?:(?:['’][{_UPPER}])?[{_LOWER}]+(?:['’-][{_UPPER}]?[{_LOWER}]+)*"
         rf"|[{_UPPER}]+(?:['’-][{_UPPER}]+)*|['’][{_UPPER}]{{2,}})")


def _either(words) -> str:
    return "|".join(sorted({re.escape(f) for w in words for f in (w, w.upper())}, key=len, reverse=True))


TITLED = re.compile(rf"(?<!\w)({_either(w for v in TITLES.values() for w in v)})(?:\. ?| )({_NAME})(?: ({_NAME}))?(?!\w)")
FULL = re.compile(rf"(?<!\w)({_either(w for v in GIVEN.values() for w in v)}) ({_NAME})(?!\w)")

NUMBERS = ("phone", "account", "social")


def script_of(word: str) -> str:
    for char in word:
        if "Ͱ" <= char <= "Ͽ" or "ἀ" <= char <= "῿":
            return "greek"
        if "Ѐ" <= char <= "ӿ":
            return "cyrillic"
    return "latin"


def _gender(given: str) -> str:
    low = given.lower()
    return next((g for (_, g), names in GIVEN.items() if low in {n.lower() for n in names}), "u")


def _idle(mention: str) -> set[int]:
    """Places of a phone mention's digits that are not part of the number."""
    return {i for m in _IDLE.finditer(mention) for i in range(*m.span())}


def _phone(run: str, plus: bool = False) -> tuple[int, str]:
    """Length and canonical form (code or leading 0|rest) of the number a run of digit groups begins with.

    A run ends with the group that completes a number: 11 digits under the codes 1 and 7,
    else the last one within 15 digits. The length is 0 if there are fewer than 7.
    """
    idle = _idle(run)
    abroad = plus or 0 in idle
    code, digits, end = "", "", 0
    for m in re.finditer(r"\d+", run):
        new = "".join(c for i, c in enumerate(m[0], m.start()) if i not in idle)
        if digits and (len(digits + new) > 15 or (abroad and digits[0] in "17" and len(digits) >= 11)):
            break
        digits, end = digits + new, m.end()
    if not 7 <= len(digits) <= 15:
        return 0, ""
    if abroad:
        code = CODE.match(digits)[0]
    elif digits[0] == "0":
        code = "0"
    elif len(digits) == 11 and re.match(r"1\D", run):
        code = "1"
    if end < len(run) and run[end] == ")" and run.count("(", 0, end) > run.count(")", 0, end):
        end += 1
    return end, f"{code}|{digits[len(code):]}"


def _phones(text: str):
    """(start, end, canonical form) of phone numbers."""
    for m in PLUS.finditer(text):
        end, form = _phone(m[0], True)
        if len(form) < (12 if form[:1] in ("1", "7") else 11):  # short, so junk may stand inside
            wide = PLUS_WIDE.match(text, m.start())
            far, other = _phone(wide[0], True) if wide else (0, "")
            end, form = (far, other) if far > end else (end, form)
        if end:
            yield m.start(), m.start() + end, form
    for m in AMERICAN.finditer(text):
        yield (*m.span(), _phone(m[0])[1])
    for m in TRUNK.finditer(text):
        end, form = _phone(m[0])
        gaps = set(re.findall(r"[^\d()]", m[0][:end]))
        if len(form) > 9 and not ("." in gaps and len(gaps) > 1):
            yield m.start(), m.start() + end, form
    for m in CALLED.finditer(text):
        end, form = _phone(m[1])
        if end:
            yield m.start(1), m.start(1) + end, form


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Entities as (start, end, kind, canonical form), in order and without overlaps."""
    found: list[tuple[int, int, str, str]] = []

    def add(match, kind: str, canonical: str, group: int = 0) -> None:
        found.append((*match.span(group), kind, canonical))

    if "@" in text:
        for m in EMAIL.finditer(text):
            add(m, "email", m[0].lower())
    if "=" in text or ":" in text:
        for m in LABELLED.finditer(text):
            if any(c.isdigit() or c.isalpha() for c in m[m.lastindex]):
                add(m, "secret", m[m.lastindex], m.lastindex)
    for m in PREFIXED.finditer(text):
        add(m, "secret", m[0])
    if any(c.isdigit() for c in text):
        for m in MIXED.finditer(text):
            if sum(c.isdigit() for c in m[0]) >= 3 and sum(c.isalpha() for c in m[0]) >= 3:
                add(m, "secret", m[0])
        for m in IBAN.finditer(text):
            compact = m[0].replace(" ", "")
            if _iban_check(compact) == compact[2:4]:
                add(m, "iban", compact)
        for m in IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                add(m, "ip", ".".join(str(int(x)) for x in m[0].split(".")))
        found += [(a, b, "phone", form) for a, b, form in _phones(text)]
        for m in SOCIAL.finditer(text):
            add(m, "social", m[0].replace("-", ""))
        for m in ACCOUNT.finditer(text):
            add(m, "account", "".join(c for c in m[0] if c.isdigit()))
    for m in TITLED.finditer(text):
        gender = next(g for g, ws in TITLES.items() if m[1].lower() in {w.lower() for w in ws})
        if m[3]:
            known = _gender(m[2])
            found.append((*m.span(2), f"given_{script_of(m[2])}_{known if known != 'u' else gender}", m[2].lower()))
        family = 3 if m[3] else 2
        add(m, f"family_{script_of(m[family])}", m[family].lower(), family)
    for m in FULL.finditer(text):
        if m[1].lower() != m[2].lower():
            found.append((*m.span(1), f"given_{script_of(m[1])}_{_gender(m[1])}", m[1].lower()))
            add(m, f"family_{script_of(m[2])}", m[2].lower(), 2)
    out, end = [], 0
    for one in sorted(found, key=lambda x: (x[0], x[0] - x[1])):
        if one[0] >= end:
            out.append(one)
            end = one[1]
    return out


def _iban_check(compact: str) -> str:
    digits = "".join(str(int(c, 36)) for c in compact[4:] + compact[:2] + "00")
    return f"{98 - int(digits) % 97:02d}"


def _luhn(digits: str) -> int:
    """The check digit that makes digits + it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


class _Draw:
    """An endless keyed stream of choices."""

    def __init__(self, key: str, *what) -> None:
        self.seed = hmac.new(key.encode(), "\x1f".join(map(str, what)).encode(), hashlib.sha256).digest()
        self.count, self.held = 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        if self.bits < 64:
            block = hashlib.sha256(self.seed + self.count.to_bytes(8, "big")).digest()
            self.count += 1
            self.held |= int.from_bytes(block, "big") << self.bits
            self.bits += 256
        value = (self.held & (1 << 64) - 1) * n >> 64
        self.held >>= 64
        self.bits -= 64
        return value

    def pick(self, choices):
        return choices[self.below(len(choices))]

    def like(self, text: str) -> str:
        """Digits for digits and letters of the same script and case for letters."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                new = self.pick(LETTERS[script_of(c)])
                out.append(new.upper() if c.isupper() else new)
            else:
                out.append(c)
        return "".join(out)

    def more(self, attempt: int) -> str:
        """Letters to add when a form has too few signs to draw from, as *****1 has."""
        return "".join(self.pick(LETTERS["latin"]) for _ in range(attempt - ROUNDS // 2))


def surrogate(kind: str, canonical: str, attempt: int, key: str) -> str:
    """The canonical form of an entity's replacement at its attempt-th draw."""
    draw = _Draw(key, kind, canonical, attempt)
    if kind == "email":
        name, _, domain = canonical.rpartition("@")
        host, _, top = domain.rpartition(".")
        # below a name that is reserved for examples, so that no real address can result
        return (f"{draw.like(name)}{draw.more(attempt)}"
                f"@{draw.like(host.removesuffix('.example'))}.example.{top}")
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "phone":
        code, _, rest = canonical.partition("|")
        if code == "0" and rest[0] != "0":  # 00 would begin a country code
            return f"0|{1 + draw.below(9)}{draw.like(rest[1:])}"
        if attempt > ROUNDS // 2 and code not in ("", "0"):  # a short number, whose code has too few others
            digits = f"{1 + draw.below(9)}{draw.like(code[1:] + rest)}"
            code = CODE.match(digits)[0]
            return f"{code}|{digits[len(code):]}"
        return f"{code}|{draw.like(rest)}"
    if kind == "account":
        body = canonical[0] + draw.like(canonical[1:-1])
        check = _luhn(body)
        if _luhn(canonical[:-1]) != int(canonical[-1]):
            check = (check + 1 + draw.below(9)) % 10
        return f"{body}{check}"
    if kind == "iban":
        body = canonical[:2] + "00" + draw.like(canonical[4:])
        return canonical[:2] + _iban_check(body) + body[4:]
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", canonical):
        return "".join(draw.pick("0123456789abcdef" if canonical.lower() == canonical
                                 else "0123456789ABCDEF") for _ in canonical)
    if kind == "secret" and (marked := KEY_PREFIX.match(canonical)):
        return marked[0] + draw.like(canonical[marked.end():]) + draw.more(attempt)
    if kind == "secret":
        return draw.like(canonical) + draw.more(attempt)
    if kind.startswith("given_"):
        _, script, gender = kind.split("_")
        names = GIVEN[script, gender if gender != "u" else draw.pick("fm")]
        return "-".join(draw.pick(names) for _ in range(1 + (attempt + 1) // 2)).lower()
    if kind.startswith("family_"):
        parts = PARTS[kind.split("_")[1]]
        return "".join(draw.pick(parts) for _ in range(3 + attempt // 2))
    return draw.like(canonical)


def dressed(kind: str, mention: str, replacement: str) -> str:
    """A replacement in the format of the mention."""
    if kind in NUMBERS or kind == "iban":
        fill = iter(replacement.replace("|", ""))
        idle = _idle(mention) if kind == "phone" else ()
        return "".join(next(fill) if c.isalnum() and i not in idle else c for i, c in enumerate(mention))
    if mention.isupper():
        return replacement.upper()
    if kind.startswith(("given_", "family_")):
        return "-".join(p.capitalize() for p in replacement.split("-"))
    return replacement


def _entity_hash(kind: str, canonical: str) -> int:
    raw = hashlib.blake2b(f"{kind}\x1f{canonical}".encode(), digest_size=8).digest()
    return int.from_bytes(raw, "big", signed=True)


def _suspects(block: T.Block, names: np.ndarray) -> np.ndarray:
    """Rows that may hold an entity: a digit, an @, the sign of a secret, or a word that announces a name."""
    mark = (block.data == 64) | ((block.data >= 48) & (block.data <= 57))
    found = T.words(block)
    at = np.minimum(np.searchsorted(names, found.hashes), len(names) - 1)
    known = names[at] == found.hashes
    texts = pa.Array.from_buffers(pa.large_binary(), block.rows, [
        None, pa.py_buffer(np.ascontiguousarray(block.offsets)), pa.py_buffer(np.ascontiguousarray(block.data))])
    announced = pc.match_substring_regex(texts, ANNOUNCED).to_numpy(zero_copy_only=False)
    return np.flatnonzero((per_row(mark, block.offsets) > 0) | (per_row(known, found.offsets) > 0) | announced)


def name_hashes() -> np.ndarray:
    listed = [w for v in [*TITLES.values(), *GIVEN.values()] for w in v]
    forms = pa.array([f for w in listed for f in (w, w.upper())])
    return np.unique(np.concatenate([T.words(b).hashes for b in T.blocks(forms)]))


def _found(batches, column: int):
    """(batch, row, text, entities) of every row that has entities."""
    names = name_hashes()
    for batch in batches:
        for block in T.blocks(batch.column(column)):
            for r in _suspects(block, names).tolist():
                text = block.data[block.offsets[r]:block.offsets[r + 1]].tobytes().decode()
                entities = detect(text)
                if entities:
                    yield batch, block.first + r, text, entities


def entities(documents: DataFrame) -> DataFrame:
    """Distinct (kind, canonical, hash) of the corpus."""

    def run(batches):
        seen: set = set()
        for _, _, _, found in _found(batches, 0):
            seen.update((kind, canonical) for _, _, kind, canonical in found)
            if len(seen) >= 50_000:
                yield _rows(seen)
                seen = set()
        yield _rows(seen)

    return (documents.select(F.col("text").cast("string"))
            .mapInArrow(run, "kind string, canonical string, hash long").distinct())


def _rows(seen: set) -> pa.RecordBatch:
    rows = sorted(seen)
    return pa.record_batch(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
         pa.array([_entity_hash(*r) for r in rows], pa.int64())],
        names=["kind", "canonical", "hash"])


def assignments(found: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, hash, attempt, surrogate), distinct per kind and apart from all entities."""

    def draw(batches):
        for batch in batches:
            kinds, forms, tries = (batch.column(i).to_pylist() for i in (0, 1, 3))
            made = [surrogate(k, c, n, key) for k, c, n in zip(kinds, forms, tries)]
            yield pa.record_batch([*batch.columns, pa.array(made, pa.string())],
                                  names=["kind", "canonical", "hash", "attempt", "surrogate"])

    schema = "kind string, canonical string, hash long, attempt int, surrogate string"
    real = found.select("kind", F.col("canonical").alias("surrogate")).withColumn("real", F.lit(True))
    held = materialize(found.withColumn("attempt", F.lit(0)).mapInArrow(draw, schema), "pii-drawn")
    for _ in range(ROUNDS):
        order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "canonical")
        judged = materialize(
            held.join(real, ["kind", "surrogate"], "left")
            .withColumn("clash", F.col("real").isNotNull() | (F.row_number().over(order) > 1))
            .drop("real"), "pii-judged")
        if judged.where("clash").isEmpty():
            return judged.drop("clash")
        columns = ["kind", "canonical", "hash", "attempt"]
        again = (judged.where("clash").select(*columns[:3], (F.col("attempt") + 1).alias("attempt"))
                 .mapInArrow(draw, schema))
        held = materialize(judged.where("NOT clash").select(*columns, "surrogate").union(again),
                           "pii-drawn")
    raise RuntimeError("surrogates still collide; the name lists are too small for this corpus")


class MissingKey(RuntimeError):
    """A session that is not local was given no key."""


def session_key(spark: SparkSession) -> str:
    """The key of the session setting, else of the driver's environment; only local sessions go without."""
    key = spark.conf.get(KEY_SETTING, None) or os.environ.get(KEY_VARIABLE)
    if key:
        return key
    if not spark.sparkContext.master.startswith("local"):
        raise MissingKey(f"set {KEY_SETTING} or {KEY_VARIABLE} to a key of your own")
    return DEFAULT_KEY


def application_key(spark: SparkSession) -> str:
    """The session's key; without one on a cluster, a random key that lasts as long as the application.

    For jobs that nobody hands a key. Nobody knows a drawn key, so nobody can list numbers and undo
    its surrogates; they agree within the application, but not with those of another one.
    """
    try:
        return session_key(spark)
    except MissingKey as missing:
        application = spark.sparkContext.applicationId
        if application not in _DRAWN:
            warnings.warn(f"{missing}; until then surrogates agree within {application} only", stacklevel=2)
        return _DRAWN.setdefault(application, secrets.token_hex(32))


def pseudonymise(documents: DataFrame, key: str | None = None, count: str | None = None) -> DataFrame:
    """The documents with entities replaced; `count` names a column for the number of mentions.

    Without a key, the session's is used.
    """
    key = key or session_key(documents.sparkSession)
    found = materialize(entities(documents), "pii-entities")
    drawn = assignments(found, key)
    redrawn = materialize(drawn.where("attempt > 0").select("kind", "canonical", "hash", "attempt"),
                          "pii-exceptions")
    kept = [c for c in documents.columns if c != count]
    copy, extra = free_name("text_copy", kept), free_name("exceptions", kept)
    mine, row_key = free_name("mentions", kept), free_name("text_key", kept)
    source = documents.select(*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias(copy))
    if redrawn.isEmpty():
        source = source.withColumn(extra, F.lit(None).cast("string"))
    else:
        text_key = F.xxhash64(F.col(copy)), F.length(copy)
        wanted = materialize(_mentions(documents, redrawn), "pii-mentions")
        source = (source.withColumn(row_key, F.concat_ws("/", *text_key))
                  .join(wanted.select(F.col("text_key").alias(row_key), F.col("exceptions").alias(extra)),
                        row_key, "left").drop(row_key)
                  .select(*[F.col(f"`{c}`") for c in kept], copy, extra))
    place = kept.index("text")
    chars = kept.index("n_chars") if "n_chars" in kept else -1
    base = documents.select(*[F.col(f"`{c}`") for c in kept]).withColumn("text", F.col("text").cast("string"))
    schema = type(base.schema)(list(base.schema.fields)).add(mine, "long")
    chars_type = base.schema[chars].dataType.simpleString() if chars >= 0 else ""

    def run(batches):
        def changed(batch_rows, batch):
            texts = batch.column(len(kept))
            columns = [batch.column(i) for i in range(len(kept))]
            numbers = np.zeros(batch.num_rows, np.int64)
            if batch_rows:
                new = texts.to_pylist()
                for r, text, n in batch_rows:
                    new[r], numbers[r] = text, n
                columns[place] = pa.array(new, pa.string())
                if chars >= 0 and chars_type in ("bigint", "int"):
                    sizes = columns[chars].to_pylist()
                    for r, text, _ in batch_rows:
                        sizes[r] = len(text)
                    columns[chars] = pa.array(sizes, columns[chars].type)
            else:
                columns[place] = texts
            return pa.record_batch([*columns, pa.array(numbers)], names=schema.names)

        for batch in batches:
            rows = []
            for _, r, text, found in _found([batch], len(kept)):
                listed = batch.column(len(kept) + 1)[r].as_py()
                tries = _parse(listed) if listed else {}
                parts, at = [], 0
                for start, end, kind, canonical in found:
                    new = surrogate(kind, canonical, tries.get((kind, canonical), 0), key)
                    parts += [text[at:start], dressed(kind, text[start:end], new)]
                    at = end
                rows.append((r, "".join(parts) + text[at:], len(found)))
            yield changed(rows, batch)

    result = source.mapInArrow(run, schema)
    return result.withColumnRenamed(mine, count) if count else result.drop(mine)


def _mentions(documents: DataFrame, redrawn: DataFrame) -> DataFrame:
    """Per text that mentions entities with a later draw, the list of them."""
    held = documents.sparkSession.sparkContext.broadcast(build_filter(redrawn, "hash").bits)

    def run(batches):
        wanted = KeyFilter(held.value)
        for batch, r, _, found in _found(batches, 0):
            pairs = sorted({(kind, canonical) for _, _, kind, canonical in found})
            hashes = np.array([_entity_hash(*p) for p in pairs], np.int64)
            pairs = [p for p, good in zip(pairs, wanted.passes(hashes)) if good]
            if pairs:
                yield pa.record_batch(
                    [pa.array([batch.column(1)[r].as_py()] * len(pairs)),
                     pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs])],
                    names=["text_key", "kind", "canonical"])

    text = F.col("text").cast("string")
    return (documents.select(text.alias("text"),
                             F.concat_ws("/", F.xxhash64(text), F.length(text)).alias("text_key"))
            .mapInArrow(run, "text_key string, kind string, canonical string").distinct()
            .join(redrawn.select("kind", "canonical", "attempt"), ["kind", "canonical"])
            .groupBy("text_key").agg(F.to_json(F.collect_list(F.struct("kind", "canonical", "attempt")))
                                     .alias("exceptions")))


def _parse(listed: str) -> dict:
    import json

    return {(x["kind"], x["canonical"]): x["attempt"] for x in json.loads(listed)}
