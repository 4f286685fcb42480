"""Canonical station and line names, as one JVM-side column expression.

Order of the rules: trim control characters and spaces at both ends, then the first matching
alias rule wins, then the parenthesis rule. ``null`` stays ``null``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the source data's conventions): alias rules in the order they are
# tried. ("equals" = whole trimmed name, "contains" = substring of the trimmed name.)
ALIAS_RULES: list[tuple[str, str, str]] = [
    ("equals", "机场北（2号航站楼）", "机场北"),
    ("contains", "机场南（1号航站楼）", "机场南"),
    ("equals", "十四号线", "知识城线"),
    ("equals", "虫雷 岗", "虫雷岗"),
    ("equals", "清㘵", "清土布"),
    ("equals", "APM", "APM线"),
    ("equals", "三北线", "三号线北延线"),
]
# The parenthesis rule. Text inside ASCII parentheses that ends in SECTION_CHAR
# gets that character replaced by LINE_CHAR.
SECTION_CHAR = "段"
LINE_CHAR = "线"

# Fixed patterns of the parenthesis rule: group 1 = text before the first '(', group 2 = text up
# to the first ')'; the first form handles an inside ending in SECTION_CHAR.
PAREN_SECTION_PATTERN = r"^([^()]*)\(([^)]*)" + SECTION_CHAR + r"\)[\s\S]*$"
PAREN_PATTERN = r"^([^()]*)\(([^)]+)\)[\s\S]*$"

# Characters U+0000..U+0020 are trimmed at both ends (plain ``trim`` only strips spaces).
CONTROL_CHARS = "".join(chr(i) for i in range(0x21))


def control_trim(c: Column | str) -> Column:
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(CONTROL_CHARS))


def canonical_name(c: Column | str, extra_aliases: Iterable[tuple[str, str]] | None = None) -> Column:
    """Canonical form of a name column.

    ``extra_aliases``: (name, replacement) pairs matched on the whole trimmed name, tried before
    the built-in rules (a user-supplied override of the alias table).
    For several columns of one DataFrame prefer :func:`canonicalize` (smaller generated code).
    """
    return alias_rules(control_trim(c), extra_aliases)


def alias_rules(t: Column, extra_aliases: Iterable[tuple[str, str]] | None = None) -> Column:
    """The alias and parenthesis rules on already trimmed text.

    Kept compact on purpose (one map lookup, one substring test, two anchored regex
    replacements) so that a projection cleaning several columns stays small enough for the
    JIT to compile the generated code.
    """
    equals = {pattern: replacement for kind, pattern, replacement in ALIAS_RULES if kind == "equals"}
    equals.update(dict(extra_aliases or []))  # user entries take precedence
    alias = F.try_element_at(F.create_map(*[F.lit(x) for kv in equals.items() for x in kv]), t)
    expr = F.when(alias.isNotNull(), alias)
    for kind, pattern, replacement in ALIAS_RULES:
        if kind == "contains":
            expr = expr.when(F.instr(t, pattern) > 0, F.lit(replacement))
    # Text before the first '(' followed by the text up to the first ')' (non-empty); the rest
    # is dropped. Inverted or empty parentheses do not match, so the trimmed name stays.
    section = F.regexp_replace(t, PAREN_SECTION_PATTERN, "$1$2" + LINE_CHAR)
    # Most names have no parenthesis, which a search tells at a fraction of the patterns' cost.
    expr = expr.when(F.instr(t, "(") > 0, F.regexp_replace(section, PAREN_PATTERN, "$1$2"))
    return expr.otherwise(t)


def canonicalize(df: DataFrame, cols: Sequence[str], extra_aliases=None) -> DataFrame:
    """Apply :func:`canonical_name` to every listed column (in place).

    The trim is computed in its own projection: the rule chain reads it many times, and the
    optimizer keeps a costly expression that is read several times in a separate projection
    instead of inlining it, which keeps the generated code small.
    """
    trimmed = df.withColumns({c: control_trim(F.col(c)) for c in cols})
    return trimmed.withColumns({c: alias_rules(F.col(c), extra_aliases) for c in cols})
