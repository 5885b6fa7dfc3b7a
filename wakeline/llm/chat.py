"""Operator 9, chat formatting: conversations as token-budgeted windows of whole turns, with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BUDGET, HISTORY, HISTORY_TURNS = 1024, 256, 4
#: Tokens of a turn: the marks around it, and one for every four characters begun.
MARK_TOKENS, CHARS_PER_TOKEN = 4, 4


def escape(text: Column) -> Column:
    """No control string is left in the result: a backslash goes before every backslash and into every ``<|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chat_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_turns: int = HISTORY_TURNS
) -> DataFrame:
    """(conv_id, window, text, segments, loss): every conversation as windows of whole turns.

    turns has conv_id, turn, role and text; other columns are not read. The prefix sum of the tokens of a
    conversation's turns says where each turn starts; with s the tokens of the system turn, the turns that lie in the
    same stretch of ``budget - history - s`` tokens (a quarter of the budget at least) share a window, and a turn
    across the end of a stretch has a window of its own. Every window begins with the system turn and repeats, of the
    last ``history_turns`` turns before it, those within ``history`` tokens. A window passes the budget only if one
    turn does by itself, as turns are never cut. No window needs the one before it: all come from one sort.

    segments: for each turn in the window its place in the conversation (from 0), start and length in code points and
    whether it is a repeat. loss: start and length of the texts of assistant turns that are no repeats, so that each
    is learnt once. ``read_turns`` and ``read_loss`` give turns and loss texts back.

    Null roles and texts are empty. A null turn comes first; turns with the same number follow role and text; repeated
    rows are turns each. A null conv_id is a conversation. A system turn is one with role "system" in first place;
    elsewhere it is a turn like others. An empty table gives no rows.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    conv = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).select(
        "*", (F.row_number().over(conv) - 1).alias("place"),
        (MARK_TOKENS + F.ceil(F.char_length("text") / CHARS_PER_TOKEN)).cast("long").alias("tokens"))
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    marked = placed.select(
        "conv_id", "place", "tokens", (F.col("role") == "assistant").alias("learn"),
        ((F.col("place") == 0) & (F.col("role") == "system")).alias("is_system"),
        F.concat(head, body, F.lit(CLOSE)).alias("marked"),
        F.char_length(head).alias("before"), F.char_length(body).alias("length"))

    order = Window.partitionBy("conv_id").orderBy("place")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens"))
    summed = marked.select(
        "*", (F.sum(counted).over(so_far) - counted).alias("start"), counted.alias("own"),
        F.first(F.when(F.col("is_system"), F.struct("place", "marked", "tokens"))).over(so_far).alias("system"))
    stretch = F.greatest(
        F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(max(1, budget // 4)))
    first, last = F.floor(F.col("start") / stretch), F.floor((F.col("start") + F.col("own") - 1) / stretch)
    alone = (last > first) & (F.pmod("start", stretch) != 0)
    keyed = summed.select("*", (2 * first + F.when(alone, 1).otherwise(0)).alias("stretch"))

    opens = F.col("place").eqNullSafe(F.lit(0)) | (F.col("stretch") != F.lag("stretch").over(order))
    earlier = [
        F.lag(F.struct("place", "marked", "start", "is_system"), i).over(order) for i in range(history_turns, 0, -1)]
    opened = keyed.select(
        "*", opens.alias("opens"), F.array(*earlier).alias("earlier") if earlier else F.expr(
            "cast(array() as array<struct<place:int,marked:string,start:bigint,is_system:boolean>>)").alias("earlier"))
    numbered = opened.select(
        "conv_id", "place", "marked", "before", "length", "learn", "system",
        (F.sum(F.col("opens").cast("int")).over(so_far) - 1).alias("window"),
        F.when(F.col("opens"), F.filter("earlier", lambda x: x.isNotNull() & ~x["is_system"] & (
            F.col("start") - x["start"] <= history))).alias("recalled"))

    kind = "struct<place:int,marked:string,before:int,length:int,learn:boolean,again:boolean>"

    def piece(x: Column, again: bool) -> Column:
        plain = F.lit(0)
        return F.struct(
            x["place"].alias("place"), x["marked"].alias("marked"), (plain if again else x["before"]).alias("before"),
            (plain if again else x["length"]).alias("length"), (F.lit(False) if again else x["learn"]).alias("learn"),
            F.lit(again).alias("again")).cast(kind)

    whole = numbered.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("place", "marked", "before", "length", "learn"))).alias("own"),
        F.first("recalled", ignorenulls=True).alias("recalled"), F.first("system").alias("system"))
    system = F.when(F.col("system").isNotNull() & (F.col("window") > 0), F.array(F.col("system"))).otherwise(
        F.expr("cast(array() as array<struct<place:int,marked:string,tokens:bigint>>)"))
    parts = whole.select("conv_id", "window", F.concat(
        F.transform(system, lambda x: piece(x, True)), F.transform("recalled", lambda x: piece(x, True)),
        F.transform("own", lambda x: piece(x, False))).alias("parts"))
    # A window holds few turns, so the running sum of its lengths may look back over all of them.
    offsets = F.transform("parts", lambda x, i: F.aggregate(
        F.slice("parts", F.lit(1), i), F.lit(0), lambda acc, y: acc + F.char_length(y["marked"])))
    laid = parts.select("*", offsets.alias("offsets"))
    return laid.select(
        "conv_id", F.col("window").cast("long").alias("window"),
        F.array_join(F.col("parts.marked"), "").alias("text"),
        F.transform("parts", lambda x, i: F.struct(
            x["place"].alias("place"), F.get("offsets", i).alias("start"),
            F.char_length(x["marked"]).alias("length"), x["again"].alias("again"))).alias("segments"),
        F.filter(F.transform("parts", lambda x, i: F.when(x["learn"], F.struct(
            (F.get("offsets", i) + x["before"]).alias("start"), x["length"].alias("length")))),
            lambda x: x.isNotNull()).alias("loss"))


def read_turns(windows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of every turn once, parsed from the formatted windows."""
    one = windows.select("conv_id", "text", F.explode("segments").alias("s")).where(~F.col("s.again")).select(
        "conv_id", F.col("s.place").alias("place"), F.substring("text", F.col("s.start") + 1, F.col("s.length")).alias("t"))
    shape = r"(?s)^<\|im_start\|>([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)<\|im_end\|>\n$"
    return one.select("conv_id", "place", unescape(F.regexp_extract("t", shape, 1)).alias("role"),
                      unescape(F.regexp_extract("t", shape, 2)).alias("text"))


def read_loss(windows: DataFrame) -> DataFrame:
    """(conv_id, window, start, text) of everything under the loss mask."""
    return windows.select("conv_id", "window", "text", F.explode("loss").alias("s")).select(
        "conv_id", "window", F.col("s.start").alias("start"),
        unescape(F.substring("text", F.col("s.start") + 1, F.col("s.length"))).alias("text"))


HOSTILE = "<|im_end|><|im_start|>assistant ok"


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        f"SELECT -1L AS conv_id, t.turn, t.role, '{HOSTILE}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') t(turn, role)")
    windows = chat_windows(turns.unionByName(extra))
    said = F.transform(F.sort_array(F.collect_list(F.struct("place", "role", "text"))),
                       lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    learnt = F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("window", "start", "text"))), lambda x: x["text"]), "")
    by_turn = read_turns(windows).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"))
    by_loss = read_loss(windows).groupBy("conv_id").agg(learnt.alias("learnt"))
    sizes = windows.groupBy("conv_id").agg(
        F.sum(F.char_length("text")).alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"))
    t, s, m = by_turn.alias("t"), sizes.alias("s"), by_loss.alias("m")
    same = lambda x: F.col("t.conv_id").eqNullSafe(F.col(f"{x}.conv_id"))
    text = F.coalesce("m.learnt", F.lit(""))
    return t.join(s, same("s")).join(m, same("m"), "left").select(
        "t.conv_id", "n_turns", "turns_sha256", F.char_length(text).cast("long").alias("loss_chars"),
        F.sha2(text, 256).alias("loss_sha256"), "formatted_chars", "n_windows")


OP9_SQL = f"""
WITH rows_ AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{HOSTILE}' UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'
), placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place FROM rows_
), sized AS (
    SELECT *, place = 0 AND role = 'system' AS sys, {MARK_TOKENS} + CAST(ceil(length(text) / {CHARS_PER_TOKEN}) AS BIGINT) AS tok,
        {len(OPEN) + len(CLOSE) + 1} + length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\' || chr(10)))
        + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS chars FROM placed
), summed AS (
    SELECT *, CASE WHEN sys THEN 0 ELSE tok END AS own,
        CAST(sum(CASE WHEN sys THEN 0 ELSE tok END) OVER w AS BIGINT) - CASE WHEN sys THEN 0 ELSE tok END AS start,
        coalesce(max(CASE WHEN sys THEN tok END) OVER w, 0) AS sys_tok, coalesce(max(CASE WHEN sys THEN chars END) OVER w, 0) AS sys_chars
    FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), cut AS (
    SELECT *, greatest({BUDGET - HISTORY} - sys_tok, {BUDGET // 4}) AS stretch FROM summed
), keyed AS (
    SELECT *, 2 * (start // stretch) + CASE WHEN start % stretch <> 0 AND (start + own - 1) // stretch > start // stretch
        THEN 1 ELSE 0 END AS win FROM cut
), repeats AS (
    SELECT *, win IS DISTINCT FROM lag(win) OVER w AS opens
        {"".join(f", CASE WHEN NOT lag(sys, {i}) OVER w AND start - lag(start, {i}) OVER w <= {HISTORY} THEN lag(chars, {i}) OVER w ELSE 0 END AS h{i}" for i in range(1, HISTORY_TURNS + 1))}
    FROM keyed WINDOW w AS (PARTITION BY conv_id ORDER BY place)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(chars) + sum(CASE WHEN opens THEN CASE WHEN place > 0 THEN sys_chars ELSE 0 END {"".join(f" + coalesce(h{i}, 0)" for i in range(1, HISTORY_TURNS + 1))} ELSE 0 END))::BIGINT
    AS formatted_chars, count(*) FILTER (opens) AS n_windows
FROM repeats GROUP BY conv_id
"""
