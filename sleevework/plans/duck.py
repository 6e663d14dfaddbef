"""Pieces of SQL text for the checking engine."""

from __future__ import annotations

from sleevework.functions.roles import EXACT_ROLES, FALLBACK_ROLE, LINE_KEYWORDS, ROLE_KEYWORDS


def role_case(label: str) -> str:
    folded = f"lower(trim({label}))"
    whens = [f"when {folded} = '{t}' then '{r}'" for t, r in EXACT_ROLES.items()]
    whens += [f"when contains({folded}, '{w}') then '{r}'" for w, r in ROLE_KEYWORDS.items()]
    return f"case {' '.join(whens)} else '{FALLBACK_ROLE}' end"


def credit_word(phrase: str) -> str:
    return "(" + " or ".join(f"contains(lower({phrase}), '{w}')" for w in LINE_KEYWORDS) + ")"


def track_set(text: str, v: str = "t") -> str:
    """A list of distinct track numbers."""
    first = f"try_cast(regexp_extract_all({v}, '\\d+')[1] as bigint)"
    last = f"try_cast(regexp_extract_all({v}, '\\d+')[2] as bigint)"
    tokens = f"regexp_extract_all({text}, '(?i)M?-?0*\\d+\\s*~\\s*M?-?0*\\d+|M?-?0*\\d+')"
    each = (
        f"case when contains({v}, '~') then case when {first} <= {last} and {last} <= {first} + 500 "
        f"then range({first}, {last} + 1) else cast([] as bigint[]) end else [{first}] end"
    )
    return f"list_distinct(flatten(list_transform({tokens}, lambda {v}: {each})))"


def names(text: str, v: str = "n") -> str:
    """A list of the names in a text."""
    parts = f"string_split_regex({text}, '(?i)\\s*(?:,|;|&|/|\\band\\b)\\s*')"
    tidy = f"list_transform({parts}, lambda {v}: trim(regexp_replace(trim({v}, ' ,;&/'), '\\s*\\([^)]*\\)\\s*$', '')))"
    return f"list_filter({tidy}, lambda {v}: regexp_matches({v}, '[\\w\\x{{3040}}-\\x{{9fff}}]') and not regexp_matches({v}, '(?i)\\bby\\b'))"


def cjk(text: str) -> str:
    return f"regexp_matches({text}, '[\\x{{3040}}-\\x{{30ff}}\\x{{3400}}-\\x{{4dbf}}\\x{{4e00}}-\\x{{9fff}}\\x{{ff00}}-\\x{{ffef}}]')"


def numbers(items: str) -> str:
    """A list of numbers as sorted text."""
    return f"array_to_string(list_sort({items}), ',')"
