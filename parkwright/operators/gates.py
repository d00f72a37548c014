"""Rule checks of chat replies, pass rates, and gates between runs."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parkwright.functions.text import let, strip

#: Common words of the language a reply should be in.
COMMON_WORDS = (
    "na ya wa kwa ni la za katika kuwa au kama sana ndiyo hapana asante tafadhali habari vizuri sawa bado sasa "
    "kila ikiwa labda pia kisha zaidi kidogo mara hii hilo yake wako wetu wake yako hapa hapo leo kesho jana "
    "fanya weka panda kata angalia hakikisha jaribu tekeleza elekea kwanza pili tatu baada kabla mpaka wakati wiki mwezi "
    "msimu shamba mavuno mbolea mvua umwagiliaji magugu mmea ndizi majani mkulima ekari kukauka wadudu ugonjwa hatua dalili "
    "kupanda udongo ukame mizizi mchirizi mazao mimea ardhi maji unaweza ninaweza itabidi inawezekana unahitaji inahitaji boresha "
    "linahitaji yanaweza nitajaribu nimeelewa kusaidia ushauri swali"
).split()
#: Words of farming, and words that tell what to do.
TOPIC_WORDS = (
    "shamba mavuno mbolea mvua umwagiliaji magugu mmea ndizi panda dawa udongo majani mkulima ekari kukauka wadudu "
    "ugonjwa hatua dalili kupanda kukata ukame mizizi mchirizi kukua kuvuna mazao mimea ardhi maji mahindi nyanya viazi "
    "mbegu kunyunyiza madoa umwagilia magonjwa"
).split()
ACTION_WORDS = "angalia weka panda kata fanya hakikisha jaribu tekeleza umwagilia ondoa tumia punguza ongeza linda tegemeza choma".split()
#: Categories with rules of their own, and words of the remaining rules.
THANKS, RELAXED = ("thanks", "acknowledgment"), ("thanks", "acknowledgment", "greeting")
THANKS_WORDS = "asante karibu sawa heri kazi nimeelewa nitajaribu".split()
OFFERS = ("ninafurahi", "naweza kukusaidia", "karibu", "msaidizi")
ECHOES = ("transcribe", "speech segment", "only output the transcription")
GREETING = r"(?i)^(?:habari(?: yako| za asubuhi| za mchana)?[!?.,\s]*)*(?:(?:ninafurahi|naweza|napenda)\s+(?:ku)?kusaidia|karibu sana|asante kwa swali lako)[!?.,\s]*$"
STEPS = r"\b[1-4][.)]\s|\b(kwanza|pili|tatu|hatua)\b"
#: The letters of tokens, and thresholds.
LETTERS = "a-zA-ZÀ-ÿ"
FRACTION, RELAXED_FRACTION, MIN_CHARS, PASS_RATE = 0.10, 0.08, 50, 0.80
#: What is added to prompts.
FOLLOWUP_CONTEXT = "[Muktadha: Mkulima na mshauri wamekuwa wakizungumza kuhusu shamba, mbolea, na wadudu. Jibu swali la ufuatiliaji kama ungekuwa na taarifa hizo tayari.]"
GREETING_REQUEST = "(Nina shida ya kilimo na nahitaji ushauri wa vitendo.)"
THANKS_SUFFIX = "\nMkulima anakushukuru — jibu kwa ukarimu na sentensi 1–2 (bila kuuliza maswali mengi)."
FOLLOWUP_SUFFIX = "\nJibu swali la ufuatiliaji kwa kutumia muktadha uliotolewa."


def _holds_any(c: Column, words) -> Column:
    """Whether any word is a substring."""
    return reduce(or_, [F.contains(c, F.lit(w)) for w in words])


def category_of(c: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown")))


def _common_count(low: Column, lexicon) -> Column:
    """How many tokens of lower-cased text are in ``lexicon``; a token is a whole run of letters."""
    return F.regexp_count(low, F.lit(f"(?<![{LETTERS}])(?:{'|'.join(sorted(set(lexicon)))})(?![{LETTERS}])"))


def _token_count(low: Column) -> Column:
    return F.regexp_count(low, F.lit(f"[{LETTERS}]+"))


def _share(low: Column, n: Column, lexicon=COMMON_WORDS) -> Column:
    return F.when(n > 0, _common_count(low, lexicon) / n)


def common_share(reply: Column, lexicon=COMMON_WORDS) -> Column:
    """Share of tokens that are common words; null without tokens."""
    return let(F.lower(reply), lambda low: let(_token_count(low), lambda n: _share(low, n, lexicon)))


def _useful(low: Column) -> Column:
    return _holds_any(low, (*TOPIC_WORDS, *ACTION_WORDS))


def _generic(t: Column, low: Column, n: Column, useful: Column, cat: Column) -> Column:
    return (
        F.when(cat.isin(*THANKS), False).when(t == "", True).when(t.rlike(GREETING), True).when(useful, False)
        .when((n <= 12) & F.contains(low, F.lit("habari")), True)
        .when((n <= 8) & _holds_any(low, OFFERS), True).otherwise(False)
    )


def _substantive(t: Column, low: Column, useful: Column, cat: Column) -> Column:
    return F.when(cat.isin(*THANKS), _holds_any(low, THANKS_WORDS)).when(useful | low.rlike(STEPS), True).otherwise(F.length(t) >= MIN_CHARS)


def generic_greeting(reply: Column, category: Column) -> Column:
    of = lambda t: let(F.lower(t), lambda low: _generic(t, low, _token_count(low), _useful(low), category_of(category)))
    return let(strip(reply), of)


def substantive(reply: Column, category: Column) -> Column:
    return let(F.lower(reply), lambda low: _substantive(strip(reply), low, _useful(low), category_of(category)))


def failed_checks(reply: Column, category: Column) -> Column:
    """Names of the checks a reply fails, in a fixed order; what several checks look at is found once."""
    cat = category_of(category)
    least = F.when(cat.isin(*RELAXED), RELAXED_FRACTION).otherwise(FRACTION)

    def names(x: Column) -> Column:
        t, low, n, useful = x["t"], x["low"], x["n"], x["useful"]
        checks = {
            "non_empty": t == "", "not_digits_only": t.rlike(r"^[\d\s.,]+$"), "not_asr_echo": _holds_any(low, ECHOES),
            "has_swahili_content": F.coalesce(_share(low, n) < least, F.lit(True)), "not_generic_greeting": _generic(t, low, n, useful, cat), "has_substance": ~_substantive(t, low, useful, cat),
        }
        return F.array_compact(F.array(*[F.when(bad, name) for name, bad in checks.items()]))

    facts = lambda t: let(F.lower(t), lambda low: let(F.struct(t.alias("t"), low.alias("low"), _token_count(low).alias("n"), _useful(low).alias("useful")), names))
    return let(strip(F.coalesce(reply, F.lit(""))), facts)


def judged(replies: DataFrame) -> DataFrame:
    """``replies`` (response, category, ...) with failed_checks and passed."""
    out = replies.withColumn("failed_checks", failed_checks(F.col("response"), F.col("category")))
    return out.withColumn("passed", F.size("failed_checks") == 0)


def augmented(prompt: Column, category: Column) -> Column:
    cat, words = category_of(category), F.size(F.array_remove(F.split(strip(prompt), r"\s+"), ""))
    return (
        F.when(cat == "followup", F.concat(F.lit(FOLLOWUP_CONTEXT + "\n"), prompt))
        .when((cat == "greeting") & F.contains(prompt, F.lit("?")) & (words < 15), F.concat(prompt, F.lit("\n" + GREETING_REQUEST))).otherwise(prompt)
    )


def message_list(prompt: Column, category: Column, system: Column) -> Column:
    """(role, content) messages: the system text with its category's suffix unless blank, then the prompt."""
    cat = category_of(category)
    suffix = F.when(cat.isin(*THANKS), THANKS_SUFFIX).when(cat == "followup", FOLLOWUP_SUFFIX).otherwise("")
    head = strip(F.concat(F.coalesce(system, F.lit("")), suffix))
    one = lambda role, body: F.struct(F.lit(role).alias("role"), F.array(F.struct(F.lit("text").alias("type"), body.alias("text"))).alias("content"))
    return F.array_compact(F.array(F.when(head != "", one("system", head)), one("user", prompt)))


def by_category(rows: DataFrame, order: str, least: float = PASS_RATE) -> DataFrame:
    """``pass_rate`` of each category, with its ``place`` among them by the first row in ``order``."""
    first = rows.groupBy("category").agg(F.min(order).alias("_first"))
    places = first.select(F.col("category").alias("_category"), F.row_number().over(Window.orderBy("_first", "category")).alias("place"))
    return pass_rate(rows, ["category"], least).join(places, F.col("category").eqNullSafe(F.col("_category"))).drop("_category")


def pass_rate(rows: DataFrame, keys: list[str], least: float = PASS_RATE) -> DataFrame:
    """n, passes, pass_rate and gate of each group; the gate reads the unrounded rate. No rows: rate 0, FAIL."""
    rate = F.coalesce(F.sum(F.col("passed").cast("long")) / F.count(F.lit(1)), F.lit(0.0))
    counts = [F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("n_passed"), rate.alias("pass_rate"), F.when(rate >= least, "PASS").otherwise("FAIL").alias("gate")]
    return rows.groupBy(*keys).agg(*counts)


def reply_score(reply: Column, failed: Column) -> Column:
    base = F.when(F.size(failed) == 0, 100).otherwise(F.greatest(F.lit(0), 100 - 15 * F.size(failed)))
    return base + F.floor(F.least(F.length(strip(reply)), F.lit(120)) / 10)


def best_attempt(attempts: DataFrame, key: str, stop_at_pass: bool = False) -> DataFrame:
    """One reply for each key: the best score, the first of equals; blanks only if there is nothing else.

    With ``stop_at_pass`` the first attempt that passes wins, as later ones would not be made.
    """
    rows = judged(attempts)
    blank = strip(F.coalesce(F.col("response"), F.lit(""))) == ""
    score = F.when(blank, -1).otherwise(reply_score(F.col("response"), F.col("failed_checks")))
    first = [F.when(F.col("passed"), F.col("attempt")).otherwise(F.lit(1 << 30))] if stop_at_pass else []
    best = Window.partitionBy(key).orderBy(*first, F.desc("score"), "attempt")
    return rows.withColumn("score", score).withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def retention(tuned: DataFrame, base: DataFrame, most: float = 0.02) -> DataFrame:
    """One row (ok, message): whether the pooled rate rose by at most ``most``; runs must be normalised alike."""
    pooled = lambda df, p: df.where("`group` = 'pooled'").agg(F.max("wer").alias(f"{p}_wer"), F.max("normalize").alias(f"{p}_mode"))
    both = pooled(tuned, "t").join(F.broadcast(pooled(base, "b")))
    delta, missing = F.col("t_wer") - F.col("b_wer"), F.col("t_wer").isNull() | F.col("b_wer").isNull()
    alike = F.col("t_mode").eqNullSafe(F.col("b_mode"))
    message = F.when(missing, "missing rate").when(~alike, "runs are normalised differently").when(delta <= most, "ok").otherwise("rate rose too much")
    return both.select(F.coalesce(~missing & alike & (delta <= most), F.lit(False)).alias("ok"), message.alias("message"), delta.alias("delta"))
