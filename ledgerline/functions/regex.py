"""Regex dialect helpers.

The original rules are Python ``re`` patterns over ``str``: ``\\b`` and ``\\w``
are Unicode-aware, ``\\s`` matches any Unicode space and ``.`` stops only at
``\\n``. Java regex (Spark) differs on all four, so patterns are rewritten by
rule into explicit character classes that mean the same thing in Java.
"""

from __future__ import annotations

import re

# A word character in Python's sense: letters, numbers, underscore.
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_WORD_CLASS = r"[^\p{L}\p{N}_]"
# Whitespace in Python's sense (str.isspace).
SPACE_CLASS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

WORD_START = rf"(?<!{WORD_CLASS})"
WORD_END = rf"(?!{WORD_CLASS})"


def java_word_regex(pattern: str) -> str:
    """Rewrite a Python pattern whose ``\\b`` sit next to word characters.

    ``\\b`` before a word character becomes a look-behind for a non-word
    character, after one a look-ahead; ``\\s`` and ``\\d`` become their
    Unicode classes. Java's ``(?d)`` makes ``.`` stop only at ``\\n``.
    """
    out = []
    i = 0
    n = len(pattern)
    while i < n:
        if pattern.startswith(r"\b", i):
            # a boundary at the very start or after a group/opening is a start
            # boundary; one at the end or before a closing is an end boundary
            before = pattern[:i]
            is_start = not before or before[-1] in "(|"
            out.append(WORD_START if is_start else WORD_END)
            i += 2
        elif pattern.startswith(r"\s", i):
            out.append(SPACE_CLASS)
            i += 2
        elif pattern.startswith(r"\d", i):
            out.append(r"\p{Nd}")
            i += 2
        elif pattern[i] == "\\" and i + 1 < n:
            out.append(pattern[i : i + 2])
            i += 2
        else:
            out.append(pattern[i])
            i += 1
    return "(?d)" + "".join(out)


def any_of(patterns) -> str:
    """One Java regex that matches when any of the Python patterns matches."""
    return "(?d)" + "|".join(f"(?:{java_word_regex(p)[4:]})" for p in patterns)


def trie_alternation(words) -> str:
    """A regex matching exactly the given literal words, factored by common
    prefixes, so a failing position is rejected after one or two characters
    instead of trying every word in turn. Longer words are tried first at a
    shared prefix, as an ordered alternation would."""
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node) -> str:
        branches = []
        end = "" in node
        for ch in sorted(k for k in node if k):
            branches.append(re.escape(ch).replace("\\ ", " ") + emit(node[ch]))
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{body})?" if end else body

    return emit(trie)


def required_literal(pattern: str) -> str:
    """The longest run of plain letters/spaces in a pattern: text can only
    match when it contains this run (used as a cheap pre-check)."""
    body = re.sub(r"\\[bsdw]", "\0", pattern)
    # a run followed by an optional quantifier is not required
    required = []
    for m in re.finditer(r"[a-z ]+", body):
        nxt = body[m.end(): m.end() + 1]
        run = m.group(0)
        if nxt in ("?", "*"):
            run = run[:-1]
        required.append(run.strip())
    return max(required, key=len) if required else ""
