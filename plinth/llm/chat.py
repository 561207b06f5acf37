"""Chat formatting by schema fingerprints.

A record's layout is told by its nested field paths. Each mapping names the paths that it needs and those that it can use;
which of these a record holds is hashed, and a hash that is in the mapping's catalogue selects it, so fields of no concern
or of another layout break nothing. Where several mappings are selected, the first of ``MAPPINGS`` wins: whole dialogues
come before single exchanges. ``layouts`` hashes all paths of the records, to see which layouts there are and which have
no mapping yet. Everything is built-in expressions over VARIANT values.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mapping:
    """turns: path of an array and its role and content fields, or fields: (role, path or paths joined by a blank line), in order.

    leads: (role, path) of texts beside the array, which go before its turns unless one of them has that role. Paths in
    ``optional`` and of leads may be missing.
    """

    name: str
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    leads: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        own = [f"{self.turns[0]}[*].{self.turns[1]}", f"{self.turns[0]}[*].{self.turns[2]}"] if self.turns else [p for _, ps in self.fields for p in ps]
        return own + [p for _, p in self.leads]

    def spare(self) -> list[str]:
        return [*self.optional, *(p for _, p in self.leads)]


_SYSTEM = ("system", ("$.system",))
_BEFORE = (("system", "$.system"), ("user", "$.prompt"))

MAPPINGS: tuple[Mapping, ...] = (
    Mapping("messages", turns=("$.messages", "role", "content"), leads=_BEFORE),
    Mapping("share", turns=("$.conversations", "from", "value"), leads=_BEFORE),
    Mapping("conversation", turns=("$.conversation", "role", "content"), leads=_BEFORE),
    Mapping("nested", turns=("$.data.turns", "speaker", "text")),
    Mapping("bare", turns=("$", "role", "content")),
    Mapping("bare_share", turns=("$", "from", "value")),
    Mapping("prompt", fields=(_SYSTEM, ("user", ("$.prompt",)), ("assistant", ("$.completion",))), optional=("$.system",)),
    Mapping("instruction", fields=(_SYSTEM, ("user", ("$.instruction", "$.input")), ("assistant", ("$.output",))), optional=("$.system", "$.input")),
    Mapping("context", fields=(_SYSTEM, ("user", ("$.instruction", "$.context")), ("assistant", ("$.response",))), optional=("$.system", "$.context")),
    Mapping("question", fields=(_SYSTEM, ("user", ("$.question",)), ("assistant", ("$.answer",))), optional=("$.system",)),
    Mapping("preference_turns", turns=("$.chosen", "role", "content"), leads=_BEFORE),
    Mapping("preference", fields=(_SYSTEM, ("user", ("$.prompt",)), ("assistant", ("$.chosen",))), optional=("$.system",)),
)
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


def known_paths(mappings: tuple[Mapping, ...] = MAPPINGS) -> list[str]:
    return sorted({p for m in mappings for p in m.paths()})


def fingerprint(paths: list[str]) -> str:
    return hashlib.md5("|".join(sorted(paths)).encode()).hexdigest()


def fingerprints(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, str]:
    """Every fingerprint that selects a mapping: its paths with and without the optional ones."""
    found: dict[str, str] = {}
    for m in mappings:
        spare = m.spare()
        must = [p for p in m.paths() if p not in spare]
        for bits in range(1 << len(spare)):
            key = fingerprint(must + [p for k, p in enumerate(spare) if bits >> k & 1])
            if found.setdefault(key, m.name) != m.name:
                raise ValueError(f"{m.name} and {found[key]} have the same fingerprint")
    return found


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _content(v: Column, path: str) -> Column:
    """A text, or the parts of a list of them: texts as they are, other parts as their JSON; null without any."""

    def part(x: Column) -> Column:
        text = F.try_variant_get(x, "$.text", "string")
        return F.when(F.try_variant_get(x, "$.type", "string") == "text", text).otherwise(F.coalesce(text, F.try_variant_get(x, "$", "string")))

    parts = F.array_compact(F.transform(F.try_variant_get(v, path, "array<variant>"), part))
    return F.when(parts.isNull(), _text(v, path)).when(F.size(parts) > 0, F.array_join(parts, "\n\n"))


def _holds(v: Column, path: str) -> Column:
    """Whether the path is there; [*] stands for any element of an array."""
    at, star, field = path.partition("[*].")
    if not star:
        return F.try_variant_get(v, path, "variant").isNotNull()
    return F.exists(F.try_variant_get(v, at, "array<variant>"), lambda x: F.try_variant_get(x, f"$.{field}", "variant").isNotNull())


def _role(c: Column) -> Column:
    """Trimmed, lower-cased and mapped; null becomes user."""
    roles = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    plain = F.lower(F.trim(c))
    return F.coalesce(F.try_element_at(roles, plain), plain, F.lit("user"))


def _turns(v: Column, m: Mapping) -> Column:
    if m.turns:
        at, role, content = m.turns
        own = F.transform(F.try_variant_get(v, at, "array<variant>"), lambda x: F.struct(_role(_text(x, f"$.{role}")).alias("role"), _content(x, f"$.{content}").alias("content")))
        roles = F.transform(own, lambda x: x["role"])
        before = [F.struct(F.lit(r).alias("role"), F.when(~F.array_contains(roles, r), _content(v, p)).alias("content")) for r, p in m.leads]
        return F.concat(F.array(*before), own) if before else own
    parts = []
    for role, paths in m.fields:
        first, *more = (_content(v, p) for p in paths)
        content = first
        for other in more:
            content = F.when(F.coalesce(other, F.lit("")) == "", content).otherwise(F.concat_ws("\n\n", content, other))
        parts.append(F.struct(F.lit(role).alias("role"), content.alias("content")))
    return F.array(*parts)


def _held(v: Column, mappings: tuple[Mapping, ...]) -> Column:
    """The known paths, null where the record lacks them: an array of its own, so that each path is looked up once."""
    return F.array(*[F.when(_holds(v, p), F.lit(p)) for p in known_paths(mappings)])


def _selected(held: Column, mappings: tuple[Mapping, ...]) -> Column:
    """struct<mapping, fingerprint> of the first mapping whose hash is in the catalogue; unmapped, with the hash of all known paths, without one."""
    prints, known = fingerprints(mappings), known_paths(mappings)

    def digest(paths: list[str]) -> Column:
        return F.md5(F.concat_ws("|", *[F.get(held, known.index(p)) for p in sorted(set(paths))]))

    found = []
    for m in mappings:
        mine = digest(m.paths())
        found.append(F.when(mine.isin([k for k, name in prints.items() if name == m.name]), F.struct(F.lit(m.name).alias("mapping"), mine.alias("fingerprint"))))
    return F.coalesce(*found, F.struct(F.lit("unmapped").alias("mapping"), digest(known).alias("fingerprint")))


def canonical_turns(records: DataFrame, raw_col: str = "raw", id_col: str = "conv_id", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, mapping, fingerprint, turn, role, content): the turns of each JSON record, numbered from 0.

    ``fingerprint`` is the hash that selected the mapping. Roles are trimmed, lower-cased and mapped to system, user and
    assistant (others stay as they are, null becomes 'user'). A content that is a list of parts becomes their texts,
    joined by blank lines. Turns without content (null) are left out, empty ones stay. A record that isn't JSON (or null)
    has mapping 'invalid', one of an unknown layout 'unmapped', and one without any turn 'empty'; each gives one row with
    null turn. Repeated records and those with a null id are converted each; unknown fields are ignored; an empty table
    gives an empty result. No shuffle.
    """
    v = F.try_parse_json(F.col("__raw"))
    one = records.select(records[id_col].alias("conv_id"), records[raw_col].cast("string").alias("__raw")).withColumn("__v", v)
    one = one.withColumn("__h", _held(F.col("__v"), mappings)).withColumn("__s", F.when(F.col("__v").isNotNull(), _selected(F.col("__h"), mappings)))
    one = one.select("conv_id", "__v", F.coalesce("__s.mapping", F.lit("invalid")).alias("mapping"), F.col("__s.fingerprint").alias("fingerprint"))
    turns = F.lit(None).cast("array<struct<role:string,content:string>>")
    for m in mappings:
        turns = F.when(F.col("mapping") == m.name, _turns(F.col("__v"), m)).otherwise(turns)
    one = one.withColumn("__turns", F.filter(turns, lambda x: x["content"].isNotNull()))
    one = one.withColumn("mapping", F.when((F.size("__turns") == 0) & ~F.col("mapping").isin("invalid", "unmapped"), "empty").otherwise(F.col("mapping")))
    flat = one.select("conv_id", "mapping", "fingerprint", F.posexplode_outer("__turns").alias("turn", "__t"))
    return flat.select("conv_id", "mapping", "fingerprint", F.col("turn").cast("int").alias("turn"), F.col("__t.role").alias("role"), F.col("__t.content").alias("content"))


def layouts(records: DataFrame, raw_col: str = "raw", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(schema, fingerprint, mapping, n): the layouts of the records: all their nested field paths without types, the hash of these, the mapping, and how many have it."""
    one = records.select(F.try_parse_json(records[raw_col].cast("string")).alias("__v"))
    full = F.regexp_replace(F.regexp_replace(F.schema_of_variant("__v"), r": (?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9,]+\))?", ""), r"ARRAY<(?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9,]+\))?>", "ARRAY<>")
    one = one.withColumn("__h", _held(F.col("__v"), mappings))
    named = one.select(full.alias("schema"), F.when(F.col("__v").isNotNull(), _selected(F.col("__h"), mappings)["mapping"]).otherwise("invalid").alias("mapping"))
    return named.groupBy("schema", "mapping").agg(F.count("*").alias("n")).select("schema", F.md5("schema").alias("fingerprint"), "mapping", "n")


#: Layouts of ``raw_records``, by conv_id modulo their number.
KINDS = ("messages", "share", "nested", "prompt", "instruction", "question", "preference", "bare", "parts", "system_share")
_SINGLE = ("prompt", "instruction", "question", "preference")


def raw_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, raw): the conversations as JSON records of ten layouts, which go round by conv_id.

    A layout for one exchange is used where the conversation is one (with or without a system turn), else messages. A
    null role counts as user. Rows without conv_id are records of one turn each.
    """
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).alias("__alone")
    turns = conversations.withColumn("role", F.coalesce("role", F.lit("user"))).groupBy("conv_id", alone).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    kind, t = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(len(KINDS))), F.col("t")
    roles = F.array_join(F.transform(t, lambda x: F.coalesce(x["role"], F.lit("?"))), ",")
    led = roles.startswith("system")
    system, shift = F.when(led, F.element_at(t, 1)["text"]), F.when(led, 1).otherwise(0)
    user, assistant = F.try_element_at(t, shift + 1)["text"], F.try_element_at(t, shift + 2)["text"]
    one = roles.isin("user,assistant", "system,user,assistant") & user.isNotNull() & assistant.isNotNull()

    def plain(x: Column) -> Column:
        return F.struct(x["role"].alias("role"), x["text"].alias("content"))

    def shared(x: Column) -> Column:
        return F.struct(F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value"))

    def parted(x: Column) -> Column:
        return F.struct(x["role"].alias("role"), F.array(F.struct(F.lit("text").alias("type"), x["text"].alias("text"))).alias("content"))

    after = F.when(led, F.slice(t, 2, F.greatest(F.lit(1), F.size(t)))).otherwise(t)
    made = {
        "messages": F.struct(F.transform(t, plain).alias("messages")),
        "share": F.struct(F.transform(t, shared).alias("conversations")),
        "nested": F.struct(F.struct(F.transform(t, lambda x: F.struct(F.initcap(x["role"]).alias("speaker"), x["text"].alias("text"))).alias("turns")).alias("data"), F.col("conv_id").alias("id")),
        "prompt": F.struct(system.alias("system"), user.alias("prompt"), assistant.alias("completion")),
        "instruction": F.struct(system.alias("system"), user.alias("instruction"), F.lit("").alias("input"), assistant.alias("output")),
        "question": F.struct(system.alias("system"), user.alias("question"), assistant.alias("answer"), F.col("conv_id").alias("id")),
        "preference": F.struct(system.alias("system"), user.alias("prompt"), assistant.alias("chosen"), F.lit("no").alias("rejected")),
        "bare": F.transform(t, plain),
        "parts": F.struct(F.transform(t, parted).alias("messages"), F.lit("q").alias("prompt_id")),
        "system_share": F.struct(system.alias("system"), F.transform(after, shared).alias("conversations")),
    }
    raw = F.to_json(made["messages"])
    for k, name in enumerate(KINDS[1:], 1):
        # Only a system turn would leave no dialogue beside it.
        fits = one if name in _SINGLE else (F.size(after) > 0) if name == "system_share" else F.lit(True)
        raw = F.when((kind == k) & fits, F.to_json(made[name])).otherwise(raw)
    return turns.select("conv_id", raw.alias("raw"))


def _oracle() -> str:
    def prints(name: str, *spare: str) -> str:
        m = next(m for m in MAPPINGS if m.name == name)
        return fingerprint([p for p in m.paths() if p not in m.spare()] + list(spare))

    def led(name: str, *spare: str) -> str:
        return f"CASE WHEN has_system THEN '{prints(name, '$.system', *spare)}' ELSE '{prints(name, *spare)}' END"

    single = " ".join(f"WHEN conv_id % {len(KINDS)} = {KINDS.index(k)} AND roles IN ('user,assistant', 'system,user,assistant') THEN '{k}'" for k in _SINGLE)
    dialogue = " ".join(f"WHEN conv_id % {len(KINDS)} = {KINDS.index(k)} THEN '{k}'" for k in ("share", "nested", "bare", "parts"))
    return f"""
WITH numbered AS (
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS turn, role, text AS content FROM (SELECT * REPLACE (coalesce(role, 'user') AS role) FROM conversations)),
shape AS (SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles FROM numbered GROUP BY conv_id),
kinds AS (
  SELECT conv_id, roles LIKE 'system%' AS has_system,
    CASE {dialogue} {single} WHEN conv_id % {len(KINDS)} = {KINDS.index("system_share")} AND roles <> 'system' THEN 'system_share' ELSE 'messages' END AS kind FROM shape)
SELECT conv_id, CASE kind WHEN 'parts' THEN 'messages' WHEN 'system_share' THEN 'share' ELSE kind END AS mapping,
  CASE kind WHEN 'share' THEN '{prints("share")}' WHEN 'nested' THEN '{prints("nested")}' WHEN 'bare' THEN '{prints("bare")}' WHEN 'system_share' THEN {led("share")}
    WHEN 'prompt' THEN {led("prompt")} WHEN 'instruction' THEN {led("instruction", "$.input")} WHEN 'question' THEN {led("question")} WHEN 'preference' THEN {led("preference")}
    ELSE '{prints("messages")}' END AS fingerprint,
  turn, role, content
FROM numbered JOIN kinds USING (conv_id)
"""


ORACLE_SQL = _oracle()
