"""Text and privacy jobs as column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Redaction ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """What a credential looks like and what stays in its place: `before`, the label, `after` ($n is a group of the pattern)."""

    label: str
    pattern: str
    before: str = ""
    after: str = ""


#: White space, word borders and the like cover all of Unicode; case is ignored only where a rule says so.
UNICODE, ANY_CASE = "(?U)", "(?iU)"
#: A value that an earlier rule has replaced is left alone.
NOT_DONE = "(?!<redacted:)"
#: Any text, as little as will do. Repeated groups are possessive everywhere: those need no stack, however long a text is.
ANYTHING = r"[\s\S]*?"


def words(name: str, joint: str) -> str:
    """A name of several words, joined as the joint says."""
    return joint.join(name.split())


def key_line(edge: str) -> str:
    """First or last line of a private key in PEM: five dashes, the edge, any capitals and blanks, `PRIVATE KEY`, five dashes."""
    dashes, kind = "-{5}", r"[A-Z\s]*"
    return rf"{dashes}{edge}{kind}PRIVATE\s+KEY{dashes}"


#: A whole key goes; of one without its last line goes all that follows, but for a line end at the very end of the text.
PEM = [
    Rule("private_key_block", rf"{UNICODE}{key_line('BEGIN')}{ANYTHING}{key_line('END')}"),
    Rule("truncated_private_key_block", rf"{UNICODE}{key_line('BEGIN')}{ANYTHING}(\n?)\z", after="$1"),
]

#: Three names of a client's settings: words joined by `_` or `-`, then `:` or `=`. The value is all up to the next blank.
SETTINGS = [Rule(words(n, "_"), rf"{ANY_CASE}({words(n, '[_-]')}\s*[=:]\s*)\S+", "$1") for n in ("refresh token", "developer token", "client secret")]

#: Names whose value is a secret, whatever stands before them.
SECRET_NAMES = ("password", "passwd", "token", "secret", "api key", "credential", "private key", "client secret", "refresh token", "developer token")


def assignment() -> Rule:
    """A secret name and its value.

    The name is a whole word, or the last part of one whose parts of ASCII letters and digits end in `_`, `.` or `-`;
    several words run together or are joined by `_` or `-`. Up to 64 parts may lead, so that time grows with the text. Then come, blanks aside, a closing quote that may
    be missing and `:`, `=` or `:=`, but not `==`, which compares. The value is what a pair of quotes holds, or else all
    up to the next blank.
    """
    # A part may not be the first word of a name of two, as it is never given back.
    part = rf"(?!(?:api|private)[-_]key\b)[a-z0-9]++[-._]"
    name = "|".join(words(n, "[_-]?") for n in SECRET_NAMES)
    separator = r"""["']?\s*(?::=?|=(?!=))\s*"""
    value = "|".join(['"[^"]*"', "'[^']*'", r"\S+"])
    return Rule("credential_assignment", rf"{ANY_CASE}\b((?:{part}){{0,64}}+(?:{name})\b{separator}){NOT_DONE}(?:{value})", "$1")


def bearer() -> Rule:
    """The word `bearer`, blanks, and sixteen or more characters that tokens are made of."""
    made_of = "[-a-z0-9._~+/=]"
    return Rule("bearer_token", rf"{ANY_CASE}\b(bearer\s+){NOT_DONE}{made_of}{{16,}}", "$1")


def url_user() -> Rule:
    """`user:password@` after a scheme of up to 64 characters: the password goes up to the last `@` before a blank, where no two of them stand side by side. Scheme and last `@` stay."""
    scheme, user, piece = "[A-Za-z][-+.A-Za-z0-9]{0,63}", r"[^/:@\s]+", r"[^@\s]++@"
    return Rule("url_credentials", rf"{UNICODE}\b({scheme}://){NOT_DONE}{user}:(?:{piece})++", "$1", "@")


def web_token() -> str:
    """Three parts joined by dots, of twenty or more URL-safe characters each; the first two are encoded JSON objects and so begin with `eyJ`."""
    part, opened = "[-_0-9A-Za-z]{20,}", "eyJ"
    return r"\b" + r"\.".join([opened + part, opened + part, part])


def vendor_token() -> str:
    """An assignment to `vercel token`, `vercel api token` or `vercel access token`: words run together or joined by `_` or `-`, quotes may stand around, twenty or more letters and digits follow."""
    joint, quote = "[_-]?", """["']?"""
    kind = "|".join(w + joint for w in ("api", "access"))
    return rf"(?iU)\bvercel{joint}(?:{kind})?token{quote}\s*[=:]\s*{quote}[0-9a-z]{{20,}}"


FIELDS = [*SETTINGS, assignment(), bearer(), url_user()]
# Prefixes, lengths and labels of known kinds of tokens.
CONTENT = [
    Rule("private_key_block", UNICODE + key_line("BEGIN")),
    Rule("base64_pem_header", r"LS0tLS1CRUdJ[A-Za-z0-9+/]"),
    Rule("google_api_key", r"AIza[0-9A-Za-z_\-]{30,}"),
    Rule("gemini_api_key", r"AQ\.[A-Za-z0-9][0-9A-Za-z_\-]{25,}"),
    Rule("github_token", r"gh[pousr]_[0-9A-Za-z]{30,}"),
    Rule("slack_token", r"xox[baprs]-[0-9A-Za-z-]{20,}"),
    Rule("aws_access_key_id", r"AKIA[0-9A-Z]{16}"),
    Rule("google_oauth_access_token", r"ya29\.[0-9A-Za-z_\-]{20,}"),
    Rule("refresh_token", r"(?<![A-Za-z0-9+/])1//[0-9A-Za-z_\-]{30,}"),
    Rule("client_secret", r"GOCSPX-[0-9A-Za-z_\-]{20,}"),
    Rule("service_account_private_key", r"(?U)\"private_key\"\s*:\s*\"-----BEGIN"),
    Rule("stripe_api_key", r"(?U)\b[spr]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("supabase_jwt_service_key", UNICODE + web_token()),
    Rule("vercel_token", vendor_token()),
    Rule("stripe_webhook_signing_secret", r"(?U)\bwhsec_[0-9A-Za-z]{16,}"),
    Rule("openrouter_api_key", r"(?U)\bsk-or-v1-[0-9A-Za-z]{32,}"),
]
#: In the order in which they are applied.
RULES = [*PEM, *FIELDS, *CONTENT]
#: Literals of which every match of a rule holds one, in lower case: with a separator for assignments, by themselves for the rest.
ASSIGNED = ("passw", "token", "secret", "key", "credential")
CUES = ("private", "bearer", "ls0tls1crudj", "aiza", "aq.", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "akia", "ya29.", "1//", "gocspx-", "k_live_", "k_test_", "eyj", "whsec_", "sk-or-v1-")


def suspicious(text: Column) -> Column:
    """Can any rule match? A few searches for literals spare most texts the chain of patterns."""
    low = F.lower(F.translate(text, "ſ", "s"))  # the one letter that is an s to patterns without case, but not in lower case
    some = lambda cues: reduce(lambda a, b: a | b, (F.contains(low, F.lit(c)) for c in cues))
    assigned = (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & some(ASSIGNED)
    user = F.contains(text, F.lit("://")) & F.contains(text, F.lit("@"))
    return assigned | user | some(CUES)


def redact(text: Column) -> Column:
    """Credentials become `<redacted:label>`, with the name of a field before them; null stays null."""
    out = text
    for r in RULES:
        out = F.regexp_replace(out, F.lit(r.pattern), F.lit(f"{r.before}<redacted:{r.label}>{r.after}"))
    return F.when(suspicious(text), out).otherwise(text)


def redact_line(text: Column) -> Column:
    """As one line: white space is collapsed first."""
    return redact(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def secret_scan(docs: DataFrame, id: str = "doc_id", text: str = "text", terms: list[str] | None = None) -> DataFrame:
    """(id, line, class) of every finding, never the value. Lines count from 1; terms are matched case-folded."""
    lines = docs.select(F.col(id).alias("id"), F.posexplode(F.split(text, "\n")).alias("n", "t"))
    classes = [F.when(F.col("t").rlike(r.pattern), F.lit(r.label)) for r in [*FIELDS, *CONTENT]]
    classes += [F.when(F.contains(F.lower("t"), F.lit(x.lower())), F.lit("term")) for x in terms or []]
    return lines.select("id", (F.col("n") + 1).alias("line"), F.explode(F.array_distinct(F.array_compact(F.array(*classes)))).alias("class"))


def perturbed(metric: Column, keys: list[Column], seed: int, spread: float = 0.15) -> Column:
    """The metric times a factor within 1 ± spread that depends on the row's keys only, so any task finds the same."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]), 256)
    unit = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return metric * (F.lit(1 - spread) + unit * F.lit(2 * spread))


def at_least(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Raise each wider count to the narrower one that it includes."""
    return df.withColumns({wide: F.when(F.col(wide).isNotNull() & F.col(narrow).isNotNull(), F.greatest(wide, narrow)).otherwise(F.col(wide)) for narrow, wide in pairs.items()})


def repaired_lags(lags: DataFrame, totals: DataFrame, keys: list[str], order: list[str], metric: str = "conversions") -> DataFrame:
    """Scale the buckets of each key so that they add up to the key's total; the last bucket takes what is left.

    A key without a total, or whose buckets sum to nothing, stays as it is.
    """
    from cohortlake.functions.columns import null_safe_join

    whole = null_safe_join(lags, totals.select(*keys, F.col(metric).alias("_target")), keys)
    w = Window.partitionBy(*keys)
    ordered = w.orderBy(*order)
    value = F.coalesce(metric, F.lit(0.0))
    out = whole.withColumns({"_sum": F.sum(value).over(w), "_n": F.row_number().over(ordered), "_last": F.count("*").over(w)})
    scaled = value * (F.col("_target") / F.col("_sum"))
    out = out.withColumn("_scaled", scaled)
    before = F.coalesce(F.sum("_scaled").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    fixed = F.when(F.col("_n") == F.col("_last"), F.col("_target") - before).otherwise(F.col("_scaled"))
    usable = F.col("_target").isNotNull() & (F.col("_sum") > 0)
    return out.withColumn(metric, F.when(usable, fixed).otherwise(F.col(metric))).drop("_target", "_sum", "_n", "_last", "_scaled")
