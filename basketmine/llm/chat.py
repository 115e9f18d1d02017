"""Chat formatting: conversations cut into budgeted, turn-aligned windows.

Turn tokens are summed up along each conversation; the prefix sums choose spans
of whole turns that fit the budget.  Every window starts with the conversation's
system turn (if it has one), repeats a limited history before its own turns, and
masks that repeated part, so each assistant text is a target exactly once.

Turns stay rows: the table is range-partitioned by conversation and turn, so a long
conversation lies in many partitions; prefix sums come from each partition's own running
sum and the totals of the partitions before it.  Blocks of ``BLOCK_WINDOWS`` budgets of
tokens are then cut into windows side by side.  A window ends at a block's edge, but its
history and the system turn reach across, as the last turns before an edge and the system
turn are sent to the next block too.  The longest row is a block, never a conversation.

Template: each turn is ``<s>role\\ntext</s>``.  Inside roles and texts ``&``, ``<``
and ``[`` are written as ``&amp;``, ``&lt;`` and ``&#91;`` (a newline in a role as
``&#10;``), so no control string can occur in them and the escape is reversible.

Defined cases: a null text or role is empty; null turns come first, turns of one number are
ordered by role and text; repeated rows all stay; a turn larger than the budget gets a
window of its own, uncut, and a turn counts one token at least; rows with a null
conversation id form one conversation.  Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BUDGET = 2048        # tokens of a window, its turns' overhead included
HISTORY_TURNS = 4    # at most so many earlier turns are repeated
HISTORY_TOKENS = 512
TURN_OVERHEAD = 4    # tokens that the template adds to a turn
BLOCK_WINDOWS = 16   # a block holds the turns that begin within so many budgets of tokens
PREFIX = 64          # characters of role and text that choose a range partition
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def token_estimate(role: Column, text: Column) -> Column:
    """Tokens of a formatted turn, escapes included, by the characters that word pieces are made of: one per four
    letters of a run of ASCII letters, one per digit, other ASCII character that is not a space, and two for three bytes of
    other text.  An estimate; give ``chat_windows`` a column of counts where the budget has to be exact."""
    whole = F.concat(escape(role), F.lit(" "), escape(text))
    letters = F.char_length(whole) - F.char_length(F.regexp_replace(whole, "[A-Za-z]", ""))
    runs = F.regexp_count(whole, F.lit("[A-Za-z]+"))
    wide = F.octet_length(F.regexp_replace(whole, "[\\x00-\\x7F]", ""))
    single = F.regexp_count(whole, F.lit("[\\x21-\\x40\\x5B-\\x60\\x7B-\\x7E]"))
    # a run of n letters is at most n / 4 + 3 / 4 groups of four
    return (F.ceil((letters + 3 * runs) / 4) + single + F.ceil(wide * 2 / 3) + TURN_OVERHEAD).cast("long")


def prefix_sums(flat: DataFrame, tokens: Column) -> DataFrame:
    """``flat(conv_id, turn, role, text)`` with ``tokens``, ``key`` (the conversation, never null), ``i`` (index of the turn),
    ``a`` (tokens before it), ``n_turns`` and ``total`` of its conversation, whose turns may lie in any number of tasks."""
    key = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    # prefixes keep the sampled range bounds small; a text only counts where its role's prefix is the whole role
    text_prefix = F.when(F.char_length("role") < PREFIX, F.substring("text", 1, PREFIX))
    ranged = flat.withColumn("key", key).repartitionByRange("key", "turn", F.substring("role", 1, PREFIX), text_prefix)
    # stored, because the number of a range partition must not change between the two readings
    # (tokens are counted behind the shuffle: the sampling of the ranges runs all that lies before it)
    ranged = stored(ranged.withColumn("tokens", tokens).withColumn("part", F.spark_partition_id()))

    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key")
    parts = ranged.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("s"))
    parts = parts.select("part", "key", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
                         F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s_before"),
                         F.sum("n").over(whole).alias("n_turns"), F.sum("s").over(whole).alias("total"))

    order = Window.partitionBy("part", "key").orderBy("turn", "role", "text")
    inner = ranged.withColumn("n", F.row_number().over(order)).withColumn(
        "s", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return inner.join(parts, ["part", "key"]).select(
        "key", "conv_id", "role", "text", "tokens", "n_turns", "total", (F.col("n_before") + F.col("n") - 1).alias("i"),
        (F.col("s_before") + F.col("s") - F.col("tokens")).alias("a"))


def chat_windows(rows: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                 history_tokens: int = HISTORY_TOKENS, tokens: str | None = None,
                 block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Windows of ``rows(conv_id, turn, role, text)``: conv_id, n_turns (of the conversation), first (own turns
    from this index, which orders the windows), n_own, n_repeated (history and system turns before them), text, and
    loss: the (start, length) code-point spans of ``text`` that are targets.

    ``tokens``: a column of ``rows`` with the tokens of each formatted turn (default: ``token_estimate``).
    """
    size = budget * block_windows
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    columns = ["conv_id", "turn", role.alias("role"), text.alias("text")]
    if tokens:
        columns.append(F.coalesce(F.col(tokens).cast("long"), F.lit(1)).alias("counted"))
    counted = F.col("counted") if tokens else token_estimate(F.col("role"), F.col("text"))
    flat = prefix_sums(rows.select(*columns), F.greatest(counted, F.lit(1)).cast("long"))

    # a turn belongs to the block it begins in; blocks whose first turns may have it as history get it too,
    # and every block of the conversation gets its system turn
    def block_of(position: Column) -> Column:
        return F.floor(position / size).cast("long")

    def entries(first: Column, last: Column, system: bool) -> Column:
        return F.transform(F.sequence(first, last), lambda n: F.struct(n.alias("block"), F.lit(system).alias("system")))

    own, far = block_of(F.col("a")), block_of(F.col("a") + history_tokens)
    reach = F.when(F.col("tokens") <= history_tokens, far).otherwise(own)
    leads = (F.col("i") == 0) & (F.col("role") == "system")
    copies = F.when(leads, F.concat(entries(own, reach, False), entries(F.lit(0).cast("long"), block_of(F.col("total") - 1), True))
                    ).otherwise(entries(own, reach, False))
    sent = flat.withColumn("to", F.explode(copies)).select("*", "to.block", "to.system")
    turn = F.struct("i", "role", "text", "a", "tokens")
    blocks = sent.groupBy("key", "block").agg(
        F.first("conv_id").alias("conv_id"), F.first("n_turns").alias("n_turns"),
        F.sort_array(F.collect_list(F.when(~F.col("system"), turn))).alias("turns"),
        F.max(F.when(F.col("system"), F.struct("tokens", "role", "text"))).alias("system"))
    blocks = (blocks.withColumn("n_earlier", F.size(F.filter("turns", lambda t: t["a"] < F.col("block") * size)))
              .where(F.col("n_earlier") < F.size("turns"))
              .withColumn("room", F.lit(budget) - history_tokens - F.coalesce(F.col("system.tokens"), F.lit(0))))

    # own spans: a turn opens a new span when the prefix sum since the span's start would pass the room
    sums = F.transform("turns", lambda t, at: F.struct(at.alias("at"), t["a"].alias("a"), (t["a"] + t["tokens"]).alias("b")))
    none = F.array().cast("array<struct<at:int,a:bigint>>")
    starts = F.aggregate(F.slice(sums, F.col("n_earlier") + 1, F.size("turns")), none, lambda acc, t: F.when(
        (F.size(acc) == 0) | (t["b"] - F.element_at(acc, -1)["a"] > F.col("room")),
        F.concat(acc, F.array(F.struct(t["at"].alias("at"), t["a"].alias("a"))))).otherwise(acc))
    blocks = blocks.withColumn("starts", F.transform(starts, lambda s: s["at"]))
    stops = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("turns")))
    has_system = F.col("system").isNotNull()

    def chosen(start: Column, stop: Column) -> Column:
        """The span's own turns behind the longest run of up to history_turns earlier turns within
        history_tokens, never the system turn."""
        first = F.get("turns", start)
        fitting = []
        for k in range(history_turns, 0, -1):
            turn_k = F.get("turns", start - k)
            fitting.append(F.when((start >= k) & (turn_k["i"] >= has_system.cast("int"))
                                  & (first["a"] - turn_k["a"] <= history_tokens), F.lit(k)))
        history = F.coalesce(*fitting, F.lit(0))
        return F.struct(first["i"].alias("first"), (stop - start).alias("n_own"), history.alias("history"),
                        F.transform(F.slice("turns", start - history + 1, stop - start + history),
                                    lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    spans = F.transform(F.arrays_zip(F.col("starts").alias("start"), stops.alias("stop")), lambda s: chosen(s["start"], s["stop"]))
    spans = blocks.select("conv_id", "n_turns", "system", F.explode(spans).alias("span")).select(
        "conv_id", "n_turns", "system", "span.*")
    keeps = (F.col("first") > 0) & has_system
    spans = spans.withColumn("keeps_system", F.when(keeps, 1).otherwise(0))
    chosen_turns = F.when(keeps, F.concat(F.array(F.struct("system.role", "system.text")), "turns")).otherwise(F.col("turns"))
    spans = spans.withColumn("n_repeated", F.col("keeps_system") + F.col("history")).withColumn(
        "parts", F.transform(chosen_turns, lambda t, i: F.struct(
            F.concat(F.lit("<s>"), _escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
            ((t["role"] == "assistant") & (i >= F.col("n_repeated"))).alias("target"))))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    close = len("</s>")

    def place(acc, p):
        begin, size = acc["at"] + F.char_length(p["head"]), F.char_length(p["body"])
        return F.struct((begin + size + close).alias("at"), F.when(
            p["target"], F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), size.alias("length"))))
        ).otherwise(acc["spans"]).alias("spans"))

    loss = F.aggregate("parts", empty, place, lambda acc: acc["spans"])
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("</s>"))), "")
    return spans.select("conv_id", "n_turns", "first", "n_own", "n_repeated", text.alias("text"), loss.alias("loss"))


def read_turns(windows: DataFrame) -> DataFrame:
    """Add ``own``: the (role, text) turns that a window holds for the first time, and ``targets``:
    the unescaped texts under its loss mask, both read back from the formatted text."""
    pieces = F.split("text", "</s>")
    parsed = F.transform(F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated")), lambda x: F.struct(
        _unescape_role(F.substring_index(F.substr(x, F.lit(4)), "\n", 1)).alias("role"),
        unescape(F.substr(x, F.locate("\n", x) + 1)).alias("text")))
    targets = F.transform("loss", lambda s: unescape(F.substr("text", s["start"] + 1, s["length"])))
    return windows.withColumn("own", parsed).withColumn("targets", targets)


def q_chat(spark, sf_dir: str) -> DataFrame:
    from .common import table
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    extra = extra.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema])
    windows = read_turns(chat_windows(rows.unionByName(extra)))
    conv = windows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("first", "own", "targets"))).alias("w"),
        F.sum(F.char_length("text")).alias("formatted_chars"), F.sum("n_own").alias("n_turns"))
    own, targets = F.flatten(F.col("w.own")), F.array_join(F.flatten(F.col("w.targets")), "")
    told = F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conv.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length(targets).cast("long").alias("loss_chars"), F.sha2(targets, 256).alias("loss_sha256"),
                       F.col("formatted_chars").cast("long").alias("formatted_chars"))
