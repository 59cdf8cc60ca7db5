"""Personal data replaced by surrogates.

Entities are found by one regular expression of all kinds. Each gets a keyed surrogate of its own kind: digits for
digits and letters for letters in the same format; card numbers pass the Luhn test and bank accounts the test of their check
digits exactly if the original does; phones keep their country code; addresses lie in ranges and under a top-level domain that nobody owns,
and what shares a mail domain shares its surrogate; names have the script of the original and the ending of their gender. The same
entity has the same surrogate wherever it occurs and however it is written (case, separators), so references stay together.
A given name is one entity whatever the title before it; its gender is that of all its gendered titles in the corpus, none if they differ.

Distinctness is checked: over all distinct entities no two may share a surrogate and no surrogate may be an
entity of the corpus; those that fail try again with a counter in the key, several tries a round, until none fails; after
``WIDER`` tries their format gets longer, so a short one cannot run out. Each document with mentions then gets the map of
its own entities to their surrogates. All of it is DataFrame operations.

Persons are found behind a title only; a name without one stays as it is.

Defined results: a null text stays null and has no entities; rows with a null doc_id and rows that repeat are treated
like others (a row is known by doc_id and a hash of its text); an empty table gives no rows; with
``replace_in`` all other columns are passed on unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, dropped, fits, load, own, written

ROUNDS, TRIES = 8, 8  # rounds, and tries of each clashing entity in a round
WIDER = 32  # tries after which a short format gets longer
ENTRY_BYTES = 160  # of an entity in a document's map

FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|госпожа|Κυρία|κυρία"
MALE = "Mr|Herr|Monsieur|Señor|Господин|господин|Κύριος|κύριος"
OTHER = "Dr|Prof"

KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d+-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?!\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "handle": r"(?<![\w@./])@[A-Za-z0-9_]{2,30}(?![\w@])",
    "person": rf"(?<![\p{{L}}\d])(?:{FEMALE}|{MALE}|{OTHER})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
#: What no entity lacks: a digit, an at sign or a title.
HINT = rf"[0-9@]|(?:{FEMALE}|{MALE}|{OTHER})\.? \p{{Lu}}"

#: Fixed syllables by script, sixteen each, for the names that surrogates get.
SYLLABLES = {
    "latin": "ba,de,fi,go,lu,ma,ne,pi,ro,su,ta,ve,wi,ko,la,mi",
    "cyrillic": "ба,де,фи,го,лу,ма,не,пи,ро,су,та,ве,ви,ко,ла,ми",
    "greek": "βα,δε,φι,γο,λου,μα,νε,πι,ρο,σου,τα,βε,βι,κο,λα,μι",
}
ENDINGS = {"latin": ("na", "no", "s"), "cyrillic": ("на", "н", "в"), "greek": ("να", "νος", "ς")}


def combined() -> str:
    """All kinds in one expression; back-references count its groups."""
    return "|".join(f"(?:{p})" for p in KINDS.values())


def _sql_string(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


# --- SQL of one mention (texts of expressions; m, kind, norm, n, key are themselves SQL) ---------------------------


def kind_sql(m: str) -> str:
    cases = " ".join(f"WHEN {m} RLIKE {_sql_string(f'^(?:{p})$')} THEN '{k}'" for k, p in KINDS.items())
    return f"(CASE {cases} ELSE 'other' END)"


def norm_sql(kind: str, m: str) -> str:
    return (
        f"(CASE WHEN {kind} = 'phone' THEN concat(IF({m} LIKE '+%', '+', ''), regexp_replace({m}, '[^0-9]', '')) WHEN {kind} IN ('card', 'ssn') THEN regexp_replace({m}, '[^0-9]', '') "
        f"WHEN {kind} = 'iban' THEN regexp_replace({m}, ' ', '') ELSE lower({m}) END)"
    )


def byte_sql(h: str, k: str) -> str:
    """The k-th number (0 to 255) of a hash in hex; it repeats after 32."""
    return f"CAST(conv(substr({h}, 2 * (({k}) % 32) + 1, 2), 16, 10) AS INT)"


def hash_sql(key: str) -> str:
    """Hash of the row (kind, norm, n) under the key."""
    return f"sha2(concat_ws(':', {_sql_string(key)}, kind, CAST(n AS STRING), norm), 256)"


def _mapped(text: str, h: str, keep: str = "0") -> str:
    """Digits for digits and letters for letters, from position ``keep`` on."""
    return f"""array_join(transform(regexp_extract_all({text}, '(?s).', 0), (c, i) -> CASE WHEN i < {keep} THEN c
        WHEN c RLIKE '[0-9]' THEN CAST({byte_sql(h, 'i')} % 10 AS STRING)
        WHEN c RLIKE '[a-z]' THEN chr(97 + {byte_sql(h, 'i')} % 26)
        WHEN c RLIKE '[A-Z]' THEN chr(65 + {byte_sql(h, 'i')} % 26) ELSE c END), '')"""


def _check_digit(payload: str) -> str:
    total = f"""aggregate(transform(regexp_extract_all(reverse({payload}), '[0-9]', 0), (d, j) -> IF(j % 2 = 0,
        (CAST(d AS INT) * 2) DIV 10 + (CAST(d AS INT) * 2) % 10, CAST(d AS INT))), 0L, (a, x) -> a + x)"""
    return f"((10 - {total} % 10) % 10)"


def name_sql(token: str, role: str, h: str, n: str) -> str:
    """A name in the script of ``token``; role f or m (given name by gender), s (surname) or x. ``n`` tries lengthen it."""
    cases = []
    for script, test in (("cyrillic", r"\\p{IsCyrillic}"), ("greek", r"\\p{IsGreek}"), ("latin", ".")):
        parts = f"split('{SYLLABLES[script]}', ',')"
        body = f"array_join(transform(sequence(0, 2 + CAST({n} AS INT) DIV 8), i -> {parts}[{byte_sql(h, 'i')} % 16]), '')"
        f, m, s = ENDINGS[script]
        cases.append(f"WHEN {token} RLIKE '{test}' THEN initcap(concat({body}, CASE {role} WHEN 'f' THEN '{f}' WHEN 'm' THEN '{m}' ELSE '{s}' END))")
    return f"(CASE {' '.join(cases)} END)"


def _mod97(account: str) -> str:
    """The remainder of an account's number (its first four characters moved to the end, letters as 10 to 35)."""
    turned = f"concat(substr({account}, 5), substr({account}, 1, 4))"
    value = "IF(c RLIKE '[0-9]', CAST(c AS INT), ascii(c) - 55)"
    return f"aggregate(regexp_extract_all({turned}, '.', 0), 0, (a, c) -> (a * IF(c RLIKE '[0-9]', 10, 100) + {value}) % 97)"


def surrogate_sql() -> str:
    """Surrogate of a row (kind, norm, role, n, h): a normalised entity, a mail domain, or a word of a name (kind name_g or name_s).

    An email's is its local part's; its domain is an entity of its own. ``n`` tries that failed widen formats that are short.
    """
    more = "array_join(transform(sequence(1, n DIV 16), i -> chr(97 + " + byte_sql("reverse(h)", "i") + " % 26)), '')"
    wider = f"IF(n >= {WIDER}, {more}, '')"
    payload = f"substr({_mapped('norm', 'h', '1')}, 1, length(norm) - 1)"
    passes = f"({_check_digit('substr(norm, 1, length(norm) - 1)')} = CAST(substr(norm, -1) AS INT))"
    body = f"substr({_mapped('norm', 'h', '4')}, 5)"
    blank = f"concat(substr(norm, 1, 2), '00', {body})"
    check = f"((98 - {_mod97(blank)} + IF({_mod97('norm')} = 1, 0, 1 + {byte_sql('h', '31')} % 96) - 2) % 97 + 2)"
    return f"""(CASE
        WHEN kind = 'email' THEN concat({_mapped("split_part(norm, '@', 1)", 'h')}, {wider})
        WHEN kind = 'domain' THEN concat({_mapped("regexp_replace(norm, '[.][^.]*$', '')", 'h')}, {wider}, '.example')
        WHEN kind = 'ip' THEN IF(n < {WIDER}, concat_ws('.', 240 + {byte_sql('h', '0')} % 16, {byte_sql('h', '1')}, {byte_sql('h', '2')}, {byte_sql('h', '3')}), concat_ws('.', '255', substr(h, 1, 8)))
        WHEN kind = 'ssn' THEN concat('9', substr({_mapped('norm', 'h')}, 2), IF(n < {WIDER}, '', substr(regexp_replace(h, '[a-f]', ''), 1, n DIV 16)))
        WHEN kind = 'card' THEN concat({payload}, CAST(({_check_digit(payload)} + IF({passes}, 0, 1 + {byte_sql('h', '31')} % 9)) % 10 AS STRING), IF(n < {WIDER}, '', substr(regexp_replace(h, '[a-f]', ''), 1, n DIV 16)))
        WHEN kind = 'iban' THEN concat(substr(norm, 1, 2), lpad(CAST({check} AS STRING), 2, '0'), {body}, {wider})
        WHEN kind = 'phone' THEN concat({_mapped('norm', 'h', "IF(norm LIKE '+%', 3, 0)")}, IF(n < {WIDER}, '', substr(regexp_replace(h, '[a-f]', ''), 1, n DIV 16)))
        WHEN kind = 'handle' THEN concat({_mapped('norm', 'h')}, {wider})
        ELSE {name_sql('norm', "IF(kind = 'name_s', 's', role)", 'h', 'n')} END)"""


def with_surrogate(rows: DataFrame, key: str) -> DataFrame:
    """(kind, norm, n) with the surrogate ``s``."""
    return rows.withColumn("h", F.expr(hash_sql(key))).withColumn("s", F.expr(surrogate_sql())).drop("h")


def _filled(m: str, s: str) -> str:
    """The characters of ``s`` in the format of the mention ``m``; what the format has no place for follows."""
    plain, size = f"regexp_replace({s}, '[+]', '')", f"length(regexp_replace({m}, '[^A-Za-z0-9]', ''))"
    return f"""concat(array_join(transform(regexp_extract_all({m}, '(?s).', 0), (c, i) -> IF(c RLIKE '[A-Za-z0-9]',
        substr({plain}, length(regexp_replace(substr({m}, 1, i + 1), '[^A-Za-z0-9]', '')), 1), c)), ''), substr({plain}, {size} + 1))"""


def _role_sql(m: str) -> str:
    return f"(CASE WHEN {m} RLIKE '^({FEMALE})[. ]' THEN 'f' WHEN {m} RLIKE '^({MALE})[. ]' THEN 'm' ELSE 'x' END)"


def entities_sql() -> str:
    """The entities of a row (m, k: its kind) as an array of (kind, norm, role); of a name its given name, if it has two words, and its
    surname; of an email address itself and its domain."""
    words = "slice(split(m, ' '), 2, 2)"
    one = lambda kind, norm, role="'x'": f"named_struct('kind', {kind}, 'norm', {norm}, 'role', {role})"
    given, last = one("'name_g'", f"lower({words}[0])", _role_sql("m")), one("'name_s'", f"lower(element_at({words}, -1))")
    plain = one("k", norm_sql("k", "m"))
    return f"""(CASE WHEN k = 'person' THEN IF(size({words}) > 1, array({given}, {last}), array({last}))
        WHEN k = 'email' THEN array({plain}, {one("'domain'", "lower(split_part(m, '@', 2))")}) ELSE array({plain}) END)"""


def replaced_sql(m: str, kind: str, known: str) -> str:
    """What stands for a mention; ``known`` is the document's map of 'kind:norm' to surrogates."""
    words = f"slice(split({m}, ' '), 2, 2)"
    plain = f"{known}[concat({kind}, ':', {norm_sql(kind, m)})]"
    given = f"{known}[concat('name_g:', lower({words}[0]))]"
    last = f"{known}[concat('name_s:', lower(element_at({words}, -1)))]"
    domain = f"{known}[concat('domain:', lower(split_part({m}, '@', 2)))]"
    return f"""(CASE WHEN {kind} = 'person' THEN concat_ws(' ', split({m}, ' ')[0], IF(size({words}) > 1, {given}, NULL), {last})
        WHEN {kind} = 'email' THEN concat({plain}, '@', {domain})
        WHEN {kind} IN ('phone', 'card', 'ssn', 'iban') THEN {_filled(m, plain)} ELSE {plain} END)"""


# --- Operator ------------------------------------------------------------------------------------------------------


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, row, m, k): distinct mentions of each document and their kinds."""
    hinted = _rows(docs).filter(F.col("text").rlike(HINT))
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(combined()), F.lit(0)))
    return hinted.select("doc_id", "row", F.explode(found).alias("m")).withColumn("k", F.expr(kind_sql("m")))


def assign(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, s): every entity with a surrogate that is unlike all others and unlike all entities.

    Rounds raise the counter of what clashes; few do, so rounds are few. What still clashes after ``ROUNDS`` has a hash put behind it.
    """
    each = found.select(F.explode(F.expr(entities_sql())).alias("e")).select("e.*").groupBy("kind", "norm")
    roles = F.collect_set(F.when(F.col("role") != "x", F.col("role")))
    each = each.agg(roles.alias("rs")).select("kind", "norm", F.when(F.size("rs") == 1, F.col("rs")[0]).otherwise("x").alias("role"))
    state = written(with_surrogate(each.withColumn("n", F.lit(0)), key), "surrogates")
    # Names are compared in lower case, as entities are, given names and surnames together; local parts within their domain.
    at = F.when(F.col("kind") == "email", F.split_part("norm", F.lit("@"), F.lit(2))).when(F.col("kind").startswith("name_"), "name").otherwise(F.col("kind")).alias("space")
    own = F.when(F.col("kind") == "email", F.split_part("norm", F.lit("@"), F.lit(1))).otherwise(F.col("norm")).alias("s")
    originals = written(state.select(at, own).distinct(), "entities")
    low = F.lower("s").alias("s")
    for turn in range(ROUNDS + 1):
        taken = state.select("kind", "norm", "role", "n", at, low)
        first = taken.groupBy("space", "s").agg(F.min(F.struct("n", "kind", "norm")).alias("first"), F.count(F.lit(1)).alias("held")).filter("held > 1")
        clash = taken.join(first, ["space", "s"]).filter(F.struct("n", "kind", "norm") != F.col("first")).select("kind", "norm")
        real = taken.join(originals.select("space", low), ["space", "s"], "left_semi").select("kind", "norm")
        again = written(clash.unionByName(real).distinct(), "surrogate-clashes")
        if not again.limit(1).count():
            break
        still = state.join(again, ["kind", "norm"], "left_anti")
        open_ = state.join(again, ["kind", "norm"], "left_semi")
        if turn == ROUNDS:
            tail = F.substring(F.sha2(F.concat_ws(":", F.lit(key), "kind", "norm"), 256), 1, 12)
            state = written(still.unionByName(open_.withColumn("s", F.concat("s", F.lit("x"), tail))), "surrogates")
            break
        tries = open_.select("kind", "norm", "role", F.explode(F.transform(F.sequence(F.lit(1), F.lit(TRIES)), lambda k: F.col("n") + k)).alias("n"))
        tries = written(with_surrogate(tries, key), "surrogate-tries")
        free = tries.select("*", at, F.lower("s").alias("low"))
        for held in (still.select(at, F.lower("s").alias("low")), originals.select("space", F.lower("s").alias("low"))):
            free = free.join(held.distinct(), ["space", "low"], "left_anti")
        won = free.groupBy("space", "low").agg(F.min(F.struct("n", "kind", "norm")).alias("w")).select("w.kind", "w.norm", "w.n")
        best = won.groupBy("kind", "norm").agg(F.min("n").alias("n"))
        last = open_.join(best, ["kind", "norm"], "left_anti").select("kind", "norm", (F.col("n") + TRIES).alias("n"))
        moved = tries.join(best.unionByName(last), ["kind", "norm", "n"], "left_semi").select(state.columns)
        before, state = state, written(still.select(state.columns).unionByName(moved), "surrogates")
        dropped(before, again, tries)
    return state.select("kind", "norm", "s")


def replace_in(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with its text replaced, and the columns ``_n`` (mentions replaced) and ``_kinds`` (their kinds, sorted)."""
    found = written(mentions(docs), "mentions")
    surrogates = assign(found, key)
    entity = F.concat_ws(":", "kind", "norm").alias("entity")
    named = found.select("doc_id", "row", F.explode(F.expr(entities_sql())).alias("e")).select("doc_id", "row", "e.kind", "e.norm").select("doc_id", "row", entity).distinct()
    # An address that a third of all documents hold is dealt over several tasks.
    told = attach(named, surrogates.select(entity, "s"), "entity", ["doc_id", "row"])
    known = told.groupBy("doc_id", "row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "s"))).alias("_cq_known"))
    known = written(known.withColumnsRenamed({"doc_id": "_cq_cid", "row": "_cq_crow"}), "known-surrogates")
    few = fits(known.agg(F.coalesce(F.sum(F.size("_cq_known")), F.lit(0))).first()[0], ENTRY_BYTES)
    rows = docs.withColumn("_cq_row", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).withColumn("_cq_id", F.col("doc_id").cast("bigint"))
    same = rows["_cq_id"].eqNullSafe(known["_cq_cid"]) & (rows["_cq_row"] == known["_cq_crow"])
    joined = rows.join(F.broadcast(known) if few else known, same, "left").select(*own(docs), "_cq_known")
    held = F.col("_cq_known").isNotNull()
    pattern = combined()
    matches = F.when(held, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.expr("CAST(array() AS ARRAY<STRING>)"))
    kinds = F.expr(f"transform(_cq_m, m -> named_struct('m', m, 'k', {kind_sql('m')}))")
    cut = joined.withColumn("_cq_m", matches).withColumn("_cq_g", F.when(held, F.split("text", pattern, -1))).withColumn("_cq_mk", kinds)
    parts = F.expr(f"zip_with(_cq_g, transform(_cq_mk, x -> {replaced_sql('x.m', 'x.k', '_cq_known')}), (g, s) -> concat(g, coalesce(s, '')))")
    text = F.when(held, F.array_join(parts, "")).otherwise(F.col("text"))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("_cq_mk.k"))), ",")
    return cut.withColumns({"text": text, "_n": F.size("_cq_m").cast("bigint"), "_kinds": kinds}).select(*own(docs), "_n", "_kinds")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = replace_in(load(spark, sf_dir, "documents").select("doc_id", "text"), key="corpus-key-1")
    return done.select("doc_id", F.col("_n").alias("n_entities"), F.col("_kinds").alias("kinds"), "text")
