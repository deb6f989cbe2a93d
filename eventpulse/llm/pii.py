r"""Personal data and secrets replaced by keyed surrogates, in DataFrame functions alone.

One pattern finds e-mail addresses, IPv4 addresses, phone numbers, card numbers, social security numbers, IBANs,
secrets, and names after a title, of any number of words. The alternative that matched is the mention's type. No group is repeated greedily, so a mention of any length needs no deep stack. In a text, the words of its detected names are replaced wherever else they stand with a
capital, by the same surrogates; they aren't counted as mentions. Mentions are cut into entities (a name's words one by one) with a
normal form: lower case, and for numbers digits only. Each distinct entity gets one surrogate from SHA-256
of the key, its type and normal form, and of an attempt number. The surrogate has the entity's form: letters stay letters of
their script and digits digits, an octet keeps its number of digits, a card keeps its first digit
and its Luhn remainder, an IBAN its country, with check digits that hold, a phone with a plus its country's calling code, a domain its last label, and given names
follow the gender of the title. An address is two entities, its mailbox within its domain and the domain, so addresses of a domain keep one in common. All mentions of an entity are rendered from its one surrogate, in the mention's own punctuation and
capitals, so coreference holds in and across documents.

Collision checks: a surrogate that two entities drew, that is taken, or that is an entity of the corpus itself, goes to
nobody, or to the first entity in order where only candidates clash; the others draw again. Hence distinct entities of a type keep distinct surrogates, and
none coincides with a real one. Where a form is used up, surrogates grow by a character at each draw, so drawing ends, whatever the entities.

A quoted secret that repeats one sign (``********``) is a mask and no mention. In other secrets every letter, of any script, every digit and every sign
is replaced; only - _ and . stay beside letters and digits.

Texts without a mention are never shuffled nor written. The pattern takes a text with mentions apart once; the parts are written, and all that follows reads
them: mentions are gathered by digest of their text and place, so a large group of copies is resolved once, and rows then meet their text's list of surrogates in one equi-join.
Three noncharacters of Unicode (U+FDD0 to U+FDD2) mark the parts; a text that holds them itself has them escaped before and restored after.

Defined results: null and empty text stay so and have no mentions. Null ids and repeated rows are kept as they
are. All columns of the input are returned in order, with the text replaced, and ``n_mentions`` after them; ``n_chars`` is set anew if its name is given. Column names
starting with ``_pii_``, and ``n_mentions``, raise ValueError. An empty table gives no rows. Overlapping finds go to the leftmost, then to the first type listed.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, materialize, table

KEY = "surrogates-1"
#: From this attempt on a surrogate is longer than its entity, by one more character at each.
WIDER_FROM = 6
_MALE, _FEMALE, _EITHER = "Mr|Herr|Monsieur|Señor|господин", "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|госпожа", "Dr|Prof"
_MALE, _FEMALE, _EITHER = (f"{t}|{t.upper()}" for t in (_MALE, _FEMALE, _EITHER))
#: A name ends with a letter, and before a possessive 's.
_NAME = r"\p{Lu}(?:['’-]*(?!(?<=['’])s(?!\p{L}))\p{L})++"
_WORD = rf"(?<![\p{{L}}\p{{N}}]){_NAME}"
#: What titles begin with, in every form listed.
_INITIALS = "".join(sorted({t[0] for t in f"{_MALE}|{_FEMALE}|{_EITHER}".split("|")}))
#: Types in order of preference; each is a pattern of Java's regular expressions without capturing groups, and one group of the whole pattern.
TYPES = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++",
    "secret": r"(?<=[\"'])(?<=(?i:token|secret|key|password|passwd)[ \t]{0,3}[=:][ \t]{0,3}[\"'])(?!(?:\*+|•+|·+|●+|\.+|…+|-+|–+|—+|_+|#+|=+|~+|\?+)[\"'])[^\"'\s]{6,}+(?=[\"'])|(?<![\p{L}\p{N}])(?:AKIA|ASIA)[0-9A-Z]{16}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])(?:gh[pousr]_|sk-)[A-Za-z0-9]{20,}+|(?<![\p{L}\p{N}])(?=[a-f]{0,64}[0-9])[0-9a-f]{32,}+(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "phone": r"(?<![\p{N}+])\+1[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|(?<![\p{N}+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,3}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d\-])\d{3}-\d{3}-\d{4}(?![\d\-])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<!\d)(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}|\d{13,19})(?!\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_MALE}|{_FEMALE}|{_EITHER})\.? {_NAME}(?: (?!(?:{_MALE}|{_FEMALE}|{_EITHER})\.? ){_NAME})*+",
}
#: What a mention of a type begins with, looked at first: at most places one character decides.
_BEGINS = {"secret": r"(?:(?<=[\"'])|(?=[0-9a-gsA]))", "ip": "(?=[0-9])", "phone": r"(?=[0-9+(])", "ssn": "(?=[0-9])", "card": "(?=[0-9])", "iban": "(?=[A-Z])", "name": f"(?=[{_INITIALS}])"}
PATTERN = "|".join(f"{_BEGINS.get(t, '')}({p})" for t, p in TYPES.items())
#: Marks around a mention, between its groups, and of an escape; and what the escape writes for each.
_AROUND, _GROUP, _ESCAPE, _WRITTEN = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd4\ufdd5\ufdd3"
_MARKED = _AROUND + _GROUP.join(f"${k + 1}" for k in range(len(TYPES))) + _AROUND
#: Every mention has a character of the first, or begins as the second says: most texts have neither, and no pattern is run over them.
_MARKS, _STARTS = r"[0-9@\"'_]", rf"[{_INITIALS}As](?:(?<=[As])(?:(?<=A)(?:KIA|SIA)|(?<=s)k-)|(?<=[{_INITIALS}])(?<=(?=(?:{_MALE}|{_FEMALE}|{_EITHER})\.? \p{{Lu}}).))"
_NUMBERS = ("phone", "ssn", "card")
#: Calling codes of one and of two digits; all others have three.
_CALLING = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_TITLE = rf"^(?:{_MALE}|{_FEMALE}|{_EITHER})\.? "
#: Syllables and endings of invented names by script; endings by gender (m, f, e for either, s for surnames).
_SYLLABLES = {"latin": "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu ma me mi mo mu na ne ni no nu ra re ri ro ru sa se si so su ta te ti to tu va ve vi vo", "cyrillic": "ба бе би бо бу да де ди до ду ка ке ки ко ку ла ле ли ло лу ма ме ми мо му на не ни но ну ра ре ри ро ру са се си со су та те ти то ту ва ве ви во"}
_ENDINGS = {"latin": {"m": "n rd ro lf", "f": "na ra lia ssa", "e": "n m ry le", "s": "ll nd rt ng"}, "cyrillic": {"m": "н р й м", "f": "на ра лия са", "e": "н м ри ле", "s": "ленко вич дзе рян"}}
_DIGITS, _ALNUM = "0123456789", "abcdefghijklmnopqrstuvwxyz0123456789"
_ACCENTED = "àâäçèéêëîïñôöùûü"
_SIGNS = "!#$%&()*+,/:;<=>?@[]^{|}~"


def _array(words: str) -> Column:
    return F.array(*(F.lit(w) for w in words.split()))


def _letters(start: int, count: int) -> Column:
    return F.lit("".join(map(chr, range(start, start + count))))


def _escaped(text: Column) -> Column:
    out = text
    for mark, code in zip((_ESCAPE, _AROUND, _GROUP), (_WRITTEN[2], _WRITTEN[0], _WRITTEN[1])):
        out = F.replace(out, F.lit(mark), F.lit(_ESCAPE + code))
    return F.when(text.rlike(f"[{_AROUND}{_GROUP}{_ESCAPE}]"), out).otherwise(text)


def _restored(text: Column) -> Column:
    out = text
    for mark, code in zip((_AROUND, _GROUP, _ESCAPE), _WRITTEN):
        out = F.replace(out, F.lit(_ESCAPE + code), F.lit(mark))
    return F.when(F.contains(text, F.lit(_ESCAPE)), out).otherwise(text)


def has_mention(text: Column) -> Column:
    return F.coalesce((text.rlike(_MARKS) | text.rlike(_STARTS)) & _escaped(text).rlike(PATTERN), F.lit(False))


def parts_of(text: Column) -> Column:
    """The text taken apart: an array of (before, kind, mention), the last one without a mention; texts are escaped."""

    def part(pieces: Column, i: Column) -> Column:
        groups = F.split(F.get(pieces, 2 * i + 1), _GROUP)
        kind = F.get(F.array(*map(F.lit, TYPES)), F.array_position(F.transform(groups, lambda g: g != ""), True).cast("int") - 1)
        return F.struct(F.get(pieces, 2 * i).alias("before"), kind.alias("kind"), F.array_join(groups, "").alias("mention"))

    marked = F.split(F.regexp_replace(_escaped(text), PATTERN, _MARKED), _AROUND, -1)
    return let(marked, lambda pieces: F.transform(F.sequence(F.lit(0), F.floor(F.size(pieces) / 2).cast("int")), lambda i: part(pieces, i)))


def entities_of(found: DataFrame) -> DataFrame:
    """From distinct (mid, kind, mention) to (mid, pos, before, form, type, norm, gender): the entities that a mention is made of."""
    m = F.col("mention")
    title = F.regexp_extract(m, _TITLE, 0)
    gender = F.when(title.rlike(f"^(?:{_FEMALE})"), "f").when(title.rlike(f"^(?:{_MALE})"), "m").otherwise("e")

    def word(w: Column, i: Column, count: Column) -> Column:
        last = i == count - 1
        return F.struct(F.when(i == 0, F.col("title")).otherwise(" ").alias("before"), w.alias("form"), F.when(last, "surname").otherwise("given").alias("type"), F.lower(w).alias("norm"), F.when(last, "s").otherwise(F.col("gender")).alias("gender"))

    plain = F.when(F.col("kind") == "phone", F.regexp_replace(m, r"[^\d+]", "")).when(F.col("kind").isin(*_NUMBERS), F.regexp_replace(m, r"\D", "")).when(F.col("kind") == "secret", m).when(F.col("kind") == "iban", F.regexp_replace(m, " ", "")).otherwise(F.lower(m))
    whole = F.array(F.struct(F.lit("").alias("before"), m.alias("form"), F.col("kind").alias("type"), plain.alias("norm"), F.lit("").alias("gender")))
    at = F.length(F.substring_index(m, "@", 1))
    domain = F.substring(m, at + 2, F.length(m))
    address = F.array(
        F.struct(F.lit("").alias("before"), F.substring(m, F.lit(1), at).alias("form"), F.lit("email").alias("type"), F.lower(m).alias("norm"), F.lit("").alias("gender")),
        F.struct(F.lit("@").alias("before"), domain.alias("form"), F.lit("domain").alias("type"), F.lower(domain).alias("norm"), F.lit("").alias("gender")),
    )
    words = let(F.split(F.substring(m, F.length("title") + 1, F.length(m)), " "), lambda ws: let(F.size(ws), lambda n: F.transform(ws, lambda w, i: word(w, i, n))))
    found = found.withColumn("title", title).withColumn("gender", gender)
    parts = found.select("mid", F.posexplode(F.when(F.col("kind") == "name", words).when(F.col("kind") == "email", address).otherwise(whole)).alias("pos", "p"))
    return parts.select("mid", "pos", "p.before", "p.form", "p.type", "p.norm", "p.gender")


def _draws(seed: Column, count: Column) -> Column:
    """At least ``count`` hexadecimal fours of a keyed stream, in strings of sixteen."""
    return let(F.sha2(seed, 256), lambda s: F.transform(F.sequence(F.lit(0), F.floor(count / 16).cast("int")), lambda k: F.sha2(F.concat(s, F.lit("|"), k.cast("string")), 256)))


def _draw(stream: Column, i: Column, below: Column | int) -> Column:
    four = F.substring(F.get(stream, F.floor(i / 16).cast("int")), (F.pmod(i, F.lit(16)) * 4 + 1).cast("int"), F.lit(4))
    return F.pmod(F.conv(four, 16, 10).cast("int"), F.lit(below) if isinstance(below, int) else below)


def _pick(alphabet: Column | str, draw: Column) -> Column:
    return F.substring(F.lit(alphabet) if isinstance(alphabet, str) else alphabet, draw + 1, F.lit(1))


def _like(c: Column, stream: Column, i: Column, hexadecimal: Column, stays: Column) -> Column:
    """A character of the same class and script as ``c``, a Latin letter for scripts without an alphabet here, and a sign for signs that don't stay."""
    code = F.ascii(c)
    between = lambda a, b: code.between(a, b)
    d = lambda n: _draw(stream, i, n)
    return (
        F.when(hexadecimal & c.rlike("[0-9a-f]"), _pick("0123456789abcdef", d(16))).when(between(48, 57), _pick("0123456789", d(10)))
        .when(between(97, 122), _pick(_letters(97, 26), d(26))).when(between(65, 90), _pick(_letters(65, 26), d(26)))
        .when(between(0xC0, 0x24F), F.when(c == F.lower(c), _pick(_ACCENTED, d(16))).otherwise(_pick(_ACCENTED.upper(), d(16))))
        .when(between(0x3B1, 0x3C9), _pick(_letters(0x3B1, 17), d(17))).when(between(0x430, 0x44F), _pick(_letters(0x430, 32), d(32))).when(between(0x410, 0x42F), _pick(_letters(0x410, 32), d(32)))
        .when(c.rlike(r"\p{L}"), F.chr(F.lit(97) + d(26))).when(c.rlike(r"\p{N}"), _pick("0123456789", d(10))).when(stays, c).otherwise(_pick(_SIGNS, d(len(_SIGNS))))
    )


def _replaced(norm: Column, stream: Column, keep_first: Column, signs: bool = False) -> Column:
    """Every character after the first ``keep_first`` replaced by one of its kind; with ``signs``, signs too. What holds for the whole is computed once."""
    facts = F.struct(norm.rlike("^(?=.*[a-f])[0-9a-f]{16,}$").alias("hex"), (norm.rlike(r"[\p{L}\p{N}]") if signs else F.lit(True)).alias("mixed"), keep_first.alias("keep"))
    stays = lambda c, f: c.rlike(r"[\-_.]") & f["mixed"] if signs else F.lit(True)
    return let(facts, lambda f: F.array_join(F.transform(F.split(norm, ""), lambda c, i: F.when(i < f["keep"], c).otherwise(_like(c, stream, i, f["hex"], stays(c, f)))), ""))


def _luhn(digits: Column) -> Column:
    """Luhn remainder of a digit string."""
    n = F.length(digits)
    value = lambda c, i: F.when(F.pmod(n - i, F.lit(2)) == 0, F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int"))).otherwise(c.cast("int"))
    return F.pmod(F.aggregate(F.transform(F.split(digits, ""), value), F.lit(0), lambda a, b: a + b), F.lit(10))


def surrogate(kind: Column, norm: Column, gender: Column, attempt: int, key: str) -> Column:
    """The normal form of the surrogate that an entity draws at an attempt."""
    seed = F.concat_ws("|", F.lit(key), kind, norm, F.lit(str(attempt)))
    stream = lambda s, n: _draws(s, n)
    size, more = F.length(norm), max(0, attempt - WIDER_FROM + 1)

    def wider(s: Column, made: Column, alphabet: str) -> Column:
        return F.concat(made, *(_pick(alphabet, _draw(s, size + j, len(alphabet))) for j in range(more))) if more else made

    def octet(stream: Column, part: Column, i: Column) -> Column:
        n = F.length(part) if attempt < 8 else F.lit(0)  # if a form is used up, octets of any length
        return F.when(n == 1, 1 + _draw(stream, i, 9)).when(n == 2, 10 + _draw(stream, i, 90)).when(n == 3, 100 + _draw(stream, i, 156)).otherwise(1 + _draw(stream, i, 254)).cast("string")

    def card(s: Column) -> Column:
        body = let(F.substring(s, F.lit(1), F.length(s) - 1), lambda b: F.concat(b, F.pmod(_luhn(norm) - _luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return body

    def address(s: Column) -> Column:
        """A mailbox, told apart from others of its real domain; the domain is an entity of its own."""
        local = F.substring_index(norm, "@", 1)
        return F.concat(wider(s, _replaced(local, s, F.lit(0)), _ALNUM), F.substring(norm, F.length(local) + 1, size))

    def domain(s: Column) -> Column:
        last = F.substring_index(norm, ".", -1)
        inner = F.substring(norm, F.lit(1), size - F.length(last) - 1)
        return F.concat(wider(s, _replaced(inner, s, F.lit(0)), _ALNUM), F.lit("."), last)

    def account(s: Column) -> Column:
        """An IBAN whose check digits hold: 98 less the remainder by 97 of what it is without them, letters counted from 10."""
        body = wider(s, _replaced(norm, s, F.lit(4)), _DIGITS)
        value = lambda c: F.ascii(c) - F.when(c.between("0", "9"), 48).otherwise(55)
        step = lambda r, c: F.pmod(r * F.when(c.between("0", "9"), 10).otherwise(100) + value(c), F.lit(97))
        left = lambda b: F.aggregate(F.split(F.concat(F.substring(b, F.lit(5), F.length(b)), F.substring(b, 1, 2), F.lit("00")), ""), F.lit(0), step)
        return let(body, lambda b: F.concat(F.substring(b, 1, 2), F.lpad((98 - left(b)).cast("string"), 2, "0"), F.substring(b, F.lit(5), F.length(b))))

    def name(s: Column) -> Column:
        def of(script: str) -> Column:
            syllables, count = _array(_SYLLABLES[script]), len(_SYLLABLES[script].split())
            body = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(1 + (attempt + 1) // 2) + F.when(gender == "s", 1).otherwise(0)), lambda i: F.get(syllables, _draw(s, i, count))), "")
            ends = F.coalesce(*(F.when(gender == g, F.get(_array(e), _draw(s, F.lit(60), 4))) for g, e in _ENDINGS[script].items()))
            return F.concat(body, ends)

        return F.when(norm.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))

    made = lambda s: (
        F.when(kind.isin("surname", "given"), name(s)).when(kind == "ip", F.array_join(F.transform(F.split(norm, r"\."), lambda p, i: octet(s, p, i)), "."))
        .when(kind == "card", let(wider(s, _replaced(norm, s, F.lit(1)), _DIGITS), card)).when(kind == "email", address(s)).when(kind == "domain", domain(s)).when(kind == "phone", wider(s, _replaced(norm, s, F.length(F.regexp_extract(norm, _CALLING, 0))), _DIGITS))
        .when(kind == "ssn", wider(s, _replaced(norm, s, F.lit(0)), _DIGITS)).when(kind == "iban", account(s))
        .otherwise(wider(s, _replaced(norm, s, F.when(norm.rlike("^(AKIA|ASIA|gh[pousr]_|sk-)"), F.lit(4)).otherwise(F.lit(0)), signs=True), _ALNUM))
    )
    return let(stream(seed, F.greatest(size + more, F.lit(64))), made)


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(type, norm, surrogate) of distinct (type, norm, gender): distinct within a type, and never an entity of the table."""
    pending, done = entities, None
    taken = entities.select(F.col("type").alias("_t"), F.col("norm").alias("_s"))
    for attempt in count():
        drawn = pending.select("type", "norm", "gender", surrogate(F.col("type"), F.col("norm"), F.col("gender"), attempt, key).alias("surrogate"))
        drawn = materialize(drawn, "pii-drawn")
        first = drawn.groupBy("type", "surrogate").agg(F.min("norm").alias("norm"))
        won = first.join(taken, (F.col("type") == F.col("_t")) & (F.col("surrogate") == F.col("_s")), "left_anti")
        won = materialize(won.select("type", "norm", "surrogate"), "pii-won")
        done = won if done is None else done.union(won)
        taken = taken.union(won.select("type", "surrogate"))
        pending = drawn.join(won.select("type", "norm"), ["type", "norm"], "left_anti")
        if pending.isEmpty():
            return done


def _rendered(kind: Column, form: Column, made: Column) -> Column:
    """The surrogate in the mention's punctuation and capitals."""
    digits = F.replace(made, F.lit("+"), F.lit(""))  # a phone's plus is in the form
    local = F.substring_index(made, "@", 1)
    copied = lambda c: F.when(kind == "iban", c == " ").otherwise(~c.rlike(r"\d"))

    def step(acc: Column, c: Column) -> Column:  # numbers are short
        out = F.when(copied(c), c).otherwise(F.substring(digits, acc["k"] + 1, F.lit(1)))
        return F.struct(F.concat(acc["t"], out).alias("t"), (acc["k"] + F.when(copied(c), 0).otherwise(1)).alias("k"))

    rest = lambda acc: F.substring(digits, acc["k"] + 1, F.length(digits))  # noqa: E731  (what is longer than the form)
    walked = F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("t"), F.lit(0).alias("k")), step, lambda acc: F.concat(acc["t"], rest(acc)))
    capitals = let(F.split(form, ""), lambda of: F.array_join(F.transform(F.split(local, ""), lambda c, i: F.when(F.get(of, i) != F.lower(F.get(of, i)), F.upper(c)).otherwise(c)), ""))
    return F.when(kind.isin("surname", "given"), _styled(form, made)).when(kind.isin("ip", "secret"), made).when(kind.isin("email", "domain"), capitals).otherwise(walked)


def _styled(form: Column, made: Column) -> Column:
    return F.when((F.length(form) > 1) & (form == F.upper(form)), F.upper(made)).otherwise(F.initcap(made))


def _known(between: Column) -> Column:
    """Text between mentions, with the words of names that its text is known to hold replaced."""
    one = lambda w: F.coalesce(_styled(w, F.element_at(F.col("_pii_words"), F.lower(w))), w, F.lit(""))
    walked = F.array_join(F.transform(F.arrays_zip(F.split(between, _WORD, -1).alias("a"), F.regexp_extract_all(between, F.lit(_WORD), F.lit(0)).alias("b")), lambda x: F.concat(x["a"], one(x["b"]))), "")
    return F.when(F.col("_pii_words").isNull(), between).otherwise(walked)


def replace_pii(docs: DataFrame, key: str = KEY, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``docs`` with every mention in ``text_col`` replaced, and a last column ``n_mentions``."""
    if clash := [c for c in docs.columns if c.lower().startswith("_pii_") or c.lower() == "n_mentions"]:
        raise ValueError(f"docs has columns of names used here: {clash}")
    text = F.col(text_col).cast("string")
    has = has_mention(text)
    others = [c for c in docs.columns if c != text_col]
    touched = docs.where(has).select(*others, F.md5(text.cast("binary")).alias("_pii_key"), parts_of(text).alias("_pii_parts"))
    touched = materialize(touched, "pii-touched")
    places = touched.select("_pii_key", F.posexplode("_pii_parts").alias("place", "p")).where("p.kind is not null")
    seen = places.select("_pii_key", "place", F.md5(F.concat_ws(":", "p.kind", "p.mention").cast("binary")).alias("mid"), "p.kind", "p.mention").distinct()
    seen = materialize(seen, "pii-seen")
    parts = materialize(entities_of(seen.select("mid", "kind", "mention").distinct()), "pii-parts")
    seen = seen.select("_pii_key", "place", "mid")
    surrogates = assign(parts.groupBy("type", "norm").agg(F.max("gender").alias("gender")), key)
    piece = F.concat("before", _rendered(F.col("type"), F.col("form"), F.col("surrogate")))
    made = parts.join(surrogates, ["type", "norm"]).groupBy("mid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", piece.alias("piece")))), lambda x: x["piece"]), "").alias("made"))
    lists = seen.join(made, "mid").groupBy("_pii_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "made"))), lambda x: x["made"]).alias("_pii_made"))
    words = parts.where("type in ('given', 'surname')").join(surrogates, ["type", "norm"]).select("mid", "norm", F.struct("type", "surrogate").alias("w")).distinct()
    words = seen.select("_pii_key", "mid").distinct().join(words, "mid").groupBy("_pii_key", "norm").agg(F.max("w").alias("w"))  # a surname goes before a given name
    lists = lists.join(words.groupBy("_pii_key").agg(F.map_from_entries(F.collect_list(F.struct("norm", "w.surrogate"))).alias("_pii_words")), "_pii_key", "left")
    new = F.array_join(F.transform("_pii_parts", lambda p, i: F.concat(_known(p["before"]), F.coalesce(F.get(F.col("_pii_made"), i), F.lit("")))), "")
    touched = touched.join(lists, "_pii_key").select(*others, _restored(new).alias("_pii_new"), (F.size("_pii_parts") - 1).cast("long").alias("n_mentions"))
    columns = [F.col("_pii_new").alias(c) if c == text_col else F.length("_pii_new").cast(docs.schema[c].dataType).alias(c) if c == chars_col else F.col(c) for c in docs.columns]
    return docs.where(~has).select(*docs.columns, F.lit(0).cast("long").alias("n_mentions")).union(touched.select(*columns, "n_mentions"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op7_pii_surrogates": op7_pii_surrogates}
ORACLES: dict[str, str] = {}
