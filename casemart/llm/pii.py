"""Personal data replaced by surrogates, with DataFrame expressions only.

Entities are found by one alternation of patterns over whole texts: email
addresses, keyed secrets, IP and hardware addresses, bank account numbers,
social security numbers, card numbers, telephone numbers, names after a title
(in Chinese: before one), and the same full names without their title elsewhere
in that text.  Each is replaced by a surrogate of its own type, drawn from a
keyed hash of its canonical form, so one entity gets one surrogate wherever it
occurs (coreference) and nothing can be reversed without the key:

* letters, digits and hexadecimal digits are replaced by their own kind, case
  and separators stay, letters stay in their script;
* the mail domain has a surrogate of its own (same domain, same surrogate), the
  top-level domain stays; an IP address keeps the digits of each part; a card
  number keeps its first digit and the state of its check digit; a bank account
  keeps country and gets valid check digits; a phone number keeps its country
  prefix and its separators, and its digits are the same however it is written;
* a name keeps its title; every word of it is replaced by a made-up word of the
  same script; the same surname, and the same given name, gets the same
  surrogate after any title.  A given name's gender is that of its titles in the
  whole table; with titles of both, or of none, it is left open.

Collision checks: two entities of a type never share a surrogate as it is
written, and no surrogate equals an entity found anywhere in the table.  The
entities that would are drawn again, until none is left; the first in order
keeps its draw.  Mail domains are settled first and an address is checked with
the surrogate of its domain.  Where a format is used up (one-letter addresses,
short domains, names, secrets), later draws are longer.

Limits: names without any title in their text, single surnames without a title,
and the different ways to write one IPv6 address are not told to be the same.

Distribution: only the texts with entities, and the distinct entities, are
shuffled.  A frequent entity is pre-aggregated by ``distinct`` and joined to
one surrogate row, which AQE can split.  Texts without entities pass through.

Edge cases: null and empty texts stay as they are; repeated rows are each
replaced alike; null ids and extra columns stay; an empty table gives an empty
result.  ``n_entities`` (name is a parameter) counts the replaced occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import query, read
from casemart.session import stage_table

_MALE = "Mr|Herr|Monsieur|Señor|Sr|M|г-н|κ"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|г-жа|κα"
_OTHER = "Dr|Prof|Professor"
_WORD = r"\p{Lu}[\p{L}'’\-]+"
_HAN = list("王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Type and pattern of each entity, in order of precedence.
PATTERNS: dict[str, str] = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]++\.)+\p{L}{2,}",
    "ip": rf"(?<![\d.\p{{L}}])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "mac": r"(?<![\p{L}\d:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![\p{L}\d:])",
    "ipv6": r"(?<![\p{L}\d:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
            r"|(?=[A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\p{L}\d:])",
    "iban": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\p{L}\d])\d(?:[ \-]?\d){12,18}(?![\p{L}\d])",
    "phone": r"(?<![\p{L}\d+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)|\d{3})[ .\-]?\d{3}[ .\-]\d{4}(?!\d)"
             r"|(?<![\p{L}\d])\+\d{1,3}(?:[ .\-]?\(?\d{2,5}\)?){2,5}(?!\d)"
             r"|(?<![\p{L}\d.+\-])[2-9]\d{2}[2-9]\d{6}(?![\p{L}\d])",
    "name": rf"(?<![\p{{L}}\d])(?:(?:{_MALE}|{_FEMALE}|{_OTHER})\.|(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Señora?|Señorita|Dr|Prof|Professor))"
            rf" {_WORD}(?: {_WORD}){{0,2}}",
    "han": rf"(?:{'|'.join(_HAN)})\p{{IsHan}}{{1,2}}(?=先生|女士|小姐|教授|博士)",
    "secret": r"(?<![\p{L}\d])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[opsur]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9\-]{20,})(?![\p{L}\d])"
              r"|(?<=[=:][\"' ]{0,3})(?<=(?i:token|secret|password|passwd|pwd|api.?key|access.?key)[\"' ]{0,3}[=:][\"' ]{0,3})"
              r"[A-Za-z0-9+/_=.\-]{6,}",
}
PATTERN = "|".join(PATTERNS.values())
#: No entity without one of these; a cheap test before the alternation.
_HINT = r"[0-9@=:]|\b(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Mlle|Señor|Sra?|Srta|M|Dr|Prof|κα?|г-н|г-жа)|先生|女士|小姐|教授|博士"

_LATIN = "ba be bo da de do fa fe fi ga ge ka ki la le li lo ma me mi na ne no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split()
_CYRILLIC = "ба бо ва ве га да де жа за зо ка ки ко ла ле ли ма ми мо на не но па по ра ре ро са се со та те то фе хо ша".split()
_GREEK = "βα βε γα γο δα δε ζα θα θε κα κι κο λα λε λι μα μι μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το φα φε χα".split()


def _lit(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _byte(i: str) -> str:
    return f"cast(conv(substr(stream, 2 * ({i}) + 1, 2), 16, 10) as int)"


def _stream(label: str, canon: str) -> str:
    """Keyed hexadecimal digits, two for each character and some more."""
    return (f"array_join(transform(sequence(0, int(length({canon}) / 32) + 1), "
            f"k -> sha2(concat_ws('\\u0001', secret_key, {label}, {canon}, attempt, k), 256)), '')")


def _mapped(text: str, digits: str = "'0123456789'") -> str:
    """Every letter or digit of ``text`` (lower case) by one of its kind."""
    def pick(alphabet: str) -> str:
        return f"substr({alphabet}, {_byte('i')} % length({alphabet}) + 1, 1)"

    return f"""array_join(transform(split({text}, ''), (c, i) -> CASE
        WHEN c RLIKE '[0-9]' THEN {pick(digits)}
        WHEN c RLIKE '[a-z]' THEN {pick("'abcdefghijklmnopqrstuvwxyz'")}
        WHEN c RLIKE '[A-Z]' THEN {pick("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'")}
        WHEN c RLIKE '\\\\p{{IsCyrillic}}' THEN {pick("'абвгдежзиклмнопрстуфхцчшэюя'")}
        WHEN c RLIKE '\\\\p{{IsGreek}}' THEN {pick("'αβγδεζηθικλμνξοπρστυφχψω'")}
        WHEN c RLIKE '\\\\p{{IsHan}}' THEN {pick("'" + "".join(_HAN) + "'")}
        WHEN c RLIKE '\\\\p{{IsLatin}}' THEN {pick("'àáâäçèéêëíîïñóôöúûü'")}
        ELSE c END), '')"""


def _luhn(digits: str) -> str:
    """Luhn sum of a string of digits, modulo 10."""
    return (f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> CASE WHEN i % 2 = 0 THEN int(c) "
            "WHEN int(c) > 4 THEN 2 * int(c) - 9 ELSE 2 * int(c) END), 0, (s, x) -> s + x, s -> s % 10)")


#: One of ten last digits makes a number pass; keep whether the original passed.
_CARD_DIGITS = "concat(substr(plain, 1, 1), substr(mapped, 2, length(plain) - 2))"
_CARD = f"""concat({_CARD_DIGITS}, cast(
    ((10 - {_luhn(f"concat({_CARD_DIGITS}, '0')")}) % 10
     + CASE WHEN {_luhn('plain')} = 0 THEN 0 ELSE 1 + {_byte('length(plain)')} % 9 END) % 10 as int))"""

_IP = f"""array_join(transform(split(canon, '[.]'), (c, i) -> cast(CASE
    WHEN attempt >= 8 THEN 1 + {_byte('i')} % 254
    WHEN length(c) = 1 THEN 1 + {_byte('i')} % 9
    WHEN length(c) = 2 THEN 10 + {_byte('i')} % 90
    ELSE 100 + {_byte('i')} % 156 END as string)), '.')"""

_IBAN_REST = "substr(mapped, 5)"
_IBAN = f"""concat(upper(substr(canon, 1, 2)), lpad(cast(98 - aggregate(
    filter(split(concat(upper({_IBAN_REST}), upper(substr(canon, 1, 2)), '00'), ''), c -> c <> ''), 0L,
    (s, c) -> CASE WHEN c RLIKE '[0-9]' THEN (s * 10 + int(c)) % 97 ELSE (s * 100 + ascii(c) - 55) % 97 END) as string), 2, '0'),
    {_IBAN_REST})"""

#: Digits of the number without its country prefix; no group of a ten-digit number begins with 0 or 1.
_PHONE = f"""array_join(transform(split(canon, ''), (c, i) -> CASE
    WHEN i = 0 OR length(canon) = 10 AND i IN (3, 6) THEN cast(2 + {_byte('i')} % 8 as string)
    ELSE cast({_byte('i')} % 10 as string) END), '')"""


def _longer(pick: str) -> str:
    """One more character every four attempts, so no format is ever used up."""
    return (f"CASE WHEN attempt >= 4 THEN array_join(transform(sequence(1, cast(attempt div 4 as int)), "
            f"j -> {pick}), '') ELSE '' END")


_LETTERS = _longer(f"substr('abcdefghijklmnopqrstuvwxyz', {_byte('31 - j % 16')} % 26 + 1, 1)")
_HEXES = _longer(f"substr('0123456789abcdef', {_byte('31 - j % 16')} % 16 + 1, 1)")


def _further(s: str, n: int) -> str:
    """One more syllable every four attempts, so the pool outgrows any number of names."""
    return (f"CASE WHEN attempt >= 4 THEN array_join(transform(sequence(4, 3 + cast(attempt div 4 as int)), "
            f"j -> element_at({s}, {_byte('j')} % {n} + 1)), '') ELSE '' END")


def _name(ending_f: str, ending_m: str, syllables: list[str]) -> str:
    s = _lit(syllables)
    body = ", ".join(f"element_at({s}, {_byte(str(i))} % {len(syllables)} + 1)" for i in range(2))
    third = f"CASE WHEN attempt > 1 THEN element_at({s}, {_byte('2')} % {len(syllables)} + 1) ELSE '' END"
    return (f"concat({body}, {third}, {_further(s, len(syllables))}, CASE kind WHEN 'given_f' THEN '{ending_f}' WHEN 'given_m' THEN '{ending_m}' "
            f"WHEN 'given_n' THEN '' ELSE element_at({s}, {_byte('3')} % {len(syllables)} + 1) || "
            f"CASE WHEN canon RLIKE '[аяα]$' THEN '{ending_f}' ELSE '{ending_m}' END END)")


_NAME = f"""CASE WHEN canon RLIKE '\\\\p{{IsCyrillic}}' THEN {_name('на', 'н', _CYRILLIC)}
    WHEN canon RLIKE '\\\\p{{IsGreek}}' THEN {_name('να', 'ς', _GREEK)}
    ELSE {_name('na', 'n', _LATIN)} END"""

_HAN_NAME = f"""concat(array_join(transform(split(canon, ''), (c, i) -> element_at({_lit(_HAN)}, {_byte('i')} % {len(_HAN)} + 1)), ''),
    {_longer(f"element_at({_lit(_HAN)}, {_byte('31 - j % 16')} % {len(_HAN)} + 1)")})"""


def _draw(units: DataFrame, key: str) -> DataFrame:
    """``units`` (kind, canon, tail, attempt) with the surrogate of that attempt;
    ``tail`` is what follows an address's local part."""
    return (units.withColumn("secret_key", F.lit(key))
            .withColumn("stream", F.expr(_stream("kind", "canon")))
            .withColumn("mapped", F.expr("CASE WHEN kind = 'secret' AND canon RLIKE '^[0-9a-f]+$' THEN "
                                         + _mapped("canon", "'0123456789abcdef'").replace("'abcdefghijklmnopqrstuvwxyz'", "'0123456789abcdef'")
                                         + " WHEN kind = 'secret' AND canon RLIKE '^[0-9A-F]+$' THEN "
                                         + _mapped("canon", "'0123456789ABCDEF'").replace("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'0123456789ABCDEF'")
                                         + " WHEN kind IN ('mac', 'ipv6') THEN "
                                         + _mapped("canon").replace("'abcdefghijklmnopqrstuvwxyz'", "'abcdef'")
                                         + f" ELSE {_mapped('canon')} END"))
            .withColumn("plain", F.col("canon"))
            .withColumn("surrogate", F.expr(f"""CASE
                WHEN kind = 'ip' THEN {_IP}
                WHEN kind = 'card' THEN {_CARD}
                WHEN kind = 'iban' THEN {_IBAN}
                WHEN kind = 'phone' THEN {_PHONE}
                WHEN kind LIKE 'given%' OR kind = 'surname' THEN {_NAME}
                WHEN kind = 'han' THEN {_HAN_NAME}
                WHEN kind = 'domain' THEN concat(regexp_extract(mapped, '^(.*)[.][^.]*$', 1), {_LETTERS}, regexp_extract(canon, '[.][^.]*$', 0))
                WHEN kind = 'email' THEN concat(regexp_extract(mapped, '^[^@]*', 0), {_LETTERS}, tail)
                WHEN kind = 'ipv6' AND canon LIKE '%::%' AND attempt >= 4 THEN concat(mapped, CASE WHEN canon LIKE '%::' THEN '' ELSE ':' END,
                    substr({_HEXES}, 1, 4))
                WHEN kind = 'secret' THEN concat(regexp_extract(canon, '^(AKIA|gh[opsur]_|sk-)?', 0),
                    substr(mapped, length(regexp_extract(canon, '^(AKIA|gh[opsur]_|sk-)?', 0)) + 1),
                    CASE WHEN canon RLIKE '^[0-9A-F]+$' THEN upper({_HEXES}) WHEN canon RLIKE '^[0-9a-f]+$' THEN {_HEXES} ELSE {_LETTERS} END)
                ELSE mapped END"""))
            .select("kind", "canon", "tail", "attempt", "surrogate"))


def _settle(units: DataFrame, key: str, most: int = 96) -> DataFrame:
    """``(kind, canon, surrogate)`` without collisions, for ``units`` (kind, canon, and perhaps tail)."""
    from pyspark.sql import Window

    if "tail" not in units.columns:
        units = units.withColumn("tail", F.lit(""))
    space = F.regexp_replace("kind", "_.$", "").alias("space")        # given names of all genders share one
    # which of two clashing entities draws again: the later one in order of canon
    turn = Window.partitionBy("space", "surrogate").orderBy("canon")
    now = stage_table(_draw(units.withColumn("attempt", F.lit(0)), key), "pii-units")
    taken = now.select(space, F.col("canon").alias("surrogate"), F.lit(True).alias("taken")).distinct()
    for _ in range(most):
        seen = (now.withColumn("space", space).withColumn("later", F.row_number().over(turn) > 1).join(taken, ["space", "surrogate"], "left")
                .withColumn("again", F.col("later") | F.coalesce("taken", F.lit(False))))
        seen = stage_table(seen.select("kind", "canon", "tail", "attempt", "surrogate", "again"), "pii-checked")
        if seen.filter("again").isEmpty():
            return seen.select("kind", "canon", "surrogate")
        redrawn = _draw(seen.filter("again").select("kind", "canon", "tail", (F.col("attempt") + 1).alias("attempt")), key)
        now = stage_table(seen.filter("NOT again").select("kind", "canon", "tail", "attempt", "surrogate").unionByName(redrawn), "pii-units")
    raise ValueError("some type has too few surrogates of its format for its entities")


def _kind(raw: Column) -> Column:
    """The type of an entity by itself; what needs its surroundings comes last."""
    out = F.when(raw.rlike(r"^\p{IsHan}+$"), F.lit("han")).when(raw.rlike(rf"^{_WORD}(?: {_WORD})+$"), F.lit("bare")).otherwise(F.lit("secret"))
    for kind, pattern in reversed([x for x in PATTERNS.items() if x[0] not in ("secret", "han")]):
        out = F.when(raw.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _parts(raws: DataFrame) -> DataFrame:
    """``(raw, type, gender, pos, kind, canon, piece)``: what of an entity is replaced, in order."""
    typed = raws.withColumn("type", _kind(F.col("raw")))
    female, male = f"^(?:{_FEMALE})$", f"^(?:{_MALE})$"
    title = F.regexp_replace(F.element_at(F.split("raw", " "), 1), r"\.$", "")
    gender = F.when(F.col("type") != "name", "n").when(title.rlike(female), "f").when(title.rlike(male), "m").otherwise("n")
    words = F.split("raw", " ")
    typed = typed.withColumn("gender", gender).withColumn("words", F.when(F.col("type") == "name", F.slice(words, 2, F.size(words))).otherwise(words))
    national = "regexp_replace(regexp_replace(raw, '^[+][0-9]{1,3}(?=[ .(-])', ''), '[^0-9]', '')"
    pieces = F.expr(f"""CASE
        WHEN type IN ('name', 'bare') THEN transform(words, (w, i) -> struct(i AS pos,
            CASE WHEN i = size(words) - 1 THEN 'surname' ELSE 'given' END AS kind, lower(w) AS canon, w AS piece))
        WHEN type IN ('card', 'iban') THEN array(struct(0 AS pos, type AS kind, regexp_replace(raw, '[ -]', '') AS canon, raw AS piece))
        WHEN type = 'phone' THEN array(struct(0 AS pos, type AS kind, CASE WHEN raw RLIKE '^[+][0-9]{{11,}}$' THEN right(raw, 10)
            ELSE {national} END AS canon, raw AS piece))
        WHEN type IN ('secret', 'han') THEN array(struct(0 AS pos, type AS kind, raw AS canon, raw AS piece))
        ELSE array(struct(0 AS pos, type AS kind, lower(raw) AS canon, raw AS piece)) END""")
    return typed.select("raw", "type", "gender", F.inline(pieces))


def _gendered(parts: DataFrame) -> DataFrame:
    """Given names by the gender of their titles, where these agree."""
    votes = (parts.filter("kind = 'given' AND gender <> 'n'").groupBy("kind", "canon")
             .agg(F.min("gender").alias("lo"), F.max("gender").alias("hi")))
    of = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("n")
    kind = F.when(F.col("kind") == "given", F.concat(F.lit("given_"), of)).otherwise(F.col("kind"))
    return parts.join(votes, ["kind", "canon"], "left").select("raw", "type", "pos", kind.alias("kind"), "canon", "piece")


def _surrogates(parts: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, surrogate)`` of all units; an address is settled with its domain's surrogate."""
    units = parts.select("kind", "canon").distinct()
    mails = units.filter("kind = 'email'").withColumn("domain", F.regexp_extract("canon", "@(.*)$", 1))
    others = units.filter("kind <> 'email'").unionByName(mails.select(F.lit("domain").alias("kind"), F.col("domain").alias("canon")).distinct())
    settled = _settle(others, key)
    tails = settled.filter("kind = 'domain'").select(F.col("canon").alias("domain"), F.concat(F.lit("@"), "surrogate").alias("tail"))
    return settled.unionByName(_settle(mails.join(tails, "domain").select("kind", "canon", "tail"), key))


#: A surrogate in the letter case, or with the separators, of the piece it replaces.
_WORN = """CASE
    WHEN kind IN ('card', 'iban') THEN array_join(transform(split(piece, ''), (c, i) -> CASE WHEN c IN (' ', '-') THEN c
        ELSE substr(surrogate, length(regexp_replace(substr(piece, 1, i + 1), '[ -]', '')), 1) END), '')
    WHEN kind = 'phone' THEN array_join(transform(split(piece, ''), (c, i) -> CASE
        WHEN c RLIKE '[0-9]' AND length(regexp_replace(substr(piece, i + 1), '[^0-9]', '')) <= length(surrogate)
        THEN substr(surrogate, length(surrogate) - length(regexp_replace(substr(piece, i + 1), '[^0-9]', '')) + 1, 1) ELSE c END), '')
    WHEN kind = 'surname' OR kind LIKE 'given%' THEN CASE WHEN piece = upper(piece) AND length(piece) > 2 THEN upper(surrogate) ELSE initcap(surrogate) END
    WHEN length(piece) = length(surrogate) THEN array_join(transform(split(surrogate, ''), (c, i) -> CASE
        WHEN substr(piece, i + 1, 1) = upper(substr(piece, i + 1, 1)) AND substr(piece, i + 1, 1) <> lower(substr(piece, i + 1, 1))
        THEN upper(c) ELSE c END), '')
    ELSE surrogate END"""


def _pattern(found: Column) -> Column:
    """The alternation, with the full names found after a title as further entities of their text."""
    titled = F.filter(found, lambda e: e.rlike(f"^(?:{PATTERNS['name']})$") & (F.size(F.split(e, " ")) > 2))
    names = F.array_distinct(F.transform(titled, lambda e: F.regexp_replace(e, "^[^ ]+ ", "")))
    longest = F.reverse(F.array_sort(F.transform(names, lambda e: F.struct(F.length(e).alias("n"), e.alias("name")))))
    listed = F.array_join(F.transform(longest, lambda e: F.concat(F.lit(r"\Q"), e["name"], F.lit(r"\E"))), "|")
    return F.when(F.size(names) > 0, F.concat(F.lit(PATTERN + r"|(?<![\p{L}\d])(?:"), listed, F.lit(r")(?![\p{L}\d])"))).otherwise(F.lit(PATTERN))


def replace_pii(df: DataFrame, key: str, text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """``df`` with surrogates in ``text_col`` and the number of replaced entities
    (an input column of that name is replaced)."""
    text, columns = F.col(f"`{text_col}`"), [c for c in df.columns if c != count_col]
    has = F.coalesce(text.rlike(_HINT) & text.rlike(PATTERN), F.lit(False))
    hits = (df.filter(has).select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), text.alias("text"),
                                  F.regexp_extract_all(text, F.lit(PATTERN), 0).alias("found"))
            .withColumn("pattern", _pattern(F.col("found")))
            .withColumn("found", F.when(F.col("pattern") == PATTERN, F.col("found")).otherwise(F.regexp_extract_all("text", "pattern", 0)))
            .withColumn("row", F.monotonically_increasing_id()))
    hits = stage_table(hits, "pii-hits")        # the row numbers are read back from here, never made again
    raws = hits.select(F.explode("found").alias("raw")).distinct()
    parts = stage_table(_gendered(stage_table(_parts(raws), "pii-found")), "pii-parts")
    worn = parts.join(_surrogates(parts, key), ["kind", "canon"]).withColumn("worn", F.expr(_WORN))
    made = worn.groupBy("raw", "type").agg(F.array_sort(F.collect_list(F.struct("pos", "worn"))).alias("p"))   # a few parts each
    spelled = F.concat_ws(" ", F.expr("transform(p, x -> x.worn)"))
    surrogate = F.when(F.col("type") == "name", F.concat_ws(" ", F.element_at(F.split("raw", " "), 1), spelled)).otherwise(spelled)
    made = stage_table(made.select("raw", surrogate.alias("surrogate")), "pii-surrogates")
    of_row = (hits.select("row", F.explode(F.array_distinct("found")).alias("raw")).join(made, "raw")
              .groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("raw", "surrogate"))).alias("of")))
    between = F.split("text", F.col("pattern"), -1)
    put = F.concat(F.transform("found", lambda e: F.col("of")[e]), F.array(F.lit("")))
    changed = hits.join(of_row, "row").withColumn("new", F.array_join(F.zip_with(between, put, lambda a, b: F.concat(a, b)), ""))
    changed = changed.select(*[F.col("new").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in columns],
                             F.size("found").cast("long").alias(count_col))
    untouched = df.filter(~has).select(*[F.col(f"`{c}`") for c in columns], F.lit(0).cast("long").alias(count_col))
    return untouched.unionByName(changed)


@query("op5_pii_surrogates")
def op5_pii_surrogates(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_pii(docs, key="corpus-2024")
