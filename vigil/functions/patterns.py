"""Signature regexes and the per-row flags derived from them.

Two pattern sets exist: the batch set (longer lists) and the live set used by
the streaming signature detector.  Both are evaluated with ``rlike`` (Java
regex, find semantics), which stays inside whole-stage codegen.  A NULL
input yields a NULL flag; flags are combined with SQL three-valued logic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PatternSet:
    tool: str
    sqli: str
    xss: str
    lfi: str


# ---------------------------------------------------------------------------
# The signature regexes, verbatim.
# ---------------------------------------------------------------------------
BATCH_PATTERNS = PatternSet(
    tool=r"(?i)(sqlmap|nikto|nmap|masscan|burpsuite|dirbuster|hydra|metasploit|w3af|acunetix|openvas)",
    sqli=r"(?i)('\s+OR|UNION\s+SELECT|1=1--|DROP\s+TABLE|xp_cmdshell|EXEC\(|INSERT\s+INTO|DELETE\s+FROM)",
    xss=r"(?i)(<script|javascript:|onerror=|alert\(|document\.cookie|eval\(|onload=)",
    lfi=r"(?i)(\.\.\/\.\.\.|/etc/passwd|/etc/shadow|/proc/self|%2e%2e%2f)",
)

STREAM_PATTERNS = PatternSet(
    tool=r"(?i)(sqlmap|nikto|nmap|masscan|burpsuite|dirbuster|hydra|metasploit|w3af|acunetix|openvas)",
    sqli=r"(?i)('\s+OR|UNION\s+SELECT|1=1--|DROP\s+TABLE|xp_cmdshell|EXEC\()",
    xss=r"(?i)(<script|javascript:|onerror=|alert\(|document\.cookie|eval\()",
    lfi=r"(?i)(\.\.\/\.\.\.|/etc/passwd|/etc/shadow|%2e%2e%2f)",
)

# Category labels and scores, highest precedence first.
BATCH_CATEGORIES = [("is_tool", "TOOL_DETECTED", 95), ("is_sqli", "SQLI", 85),
                    ("is_xss", "XSS", 75), ("is_lfi", "LFI", 70)]
BATCH_FALLBACK = ("UNKNOWN", 60)
STREAM_CATEGORIES = [("is_tool", "KNOWN_ATTACK_TOOL", 95), ("is_sqli", "SQLI_DETECTED", 85),
                     ("is_xss", "XSS_DETECTED", 75), ("is_lfi", "LFI_DETECTED", 70)]
STREAM_FALLBACK = ("SIGNATURE_MATCH", 60)

FLAG_COLUMNS = ["is_sqli", "is_xss", "is_lfi", "is_tool"]


def flag_columns(patterns: PatternSet, agent: str = "user_agent", path: str = "request_path") -> dict[str, Column]:
    """The four match flags as named column expressions."""
    return {
        "is_sqli": F.col(path).rlike(patterns.sqli),
        "is_xss": F.col(path).rlike(patterns.xss),
        "is_lfi": F.col(path).rlike(patterns.lfi),
        "is_tool": F.col(agent).rlike(patterns.tool),
    }


def any_flag() -> Column:
    return F.col("is_sqli") | F.col("is_xss") | F.col("is_lfi") | F.col("is_tool")


def by_precedence(categories, fallback, pick: int) -> Column:
    """``CASE`` over the flags in precedence order; ``pick`` 1 = label, 2 = score."""
    expr = None
    for flag, label, score in categories:
        value = F.lit(label) if pick == 1 else F.lit(score)
        expr = F.when(F.col(flag), value) if expr is None else expr.when(F.col(flag), value)
    return expr.otherwise(F.lit(fallback[pick - 1]))
