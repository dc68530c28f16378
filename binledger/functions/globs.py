"""Raw URI paths and glob patterns over them."""

import re
from dataclasses import dataclass

# One character of a raw URI path, plain or percent-encoded, and a run of them
# that does not end inside an encoded one.
_ONE = "(?:%[0-9A-Fa-f]{2}|[^/%])"
_RUN = "[^/]*(?<!%)(?<!%[0-9A-Fa-f])"

# ASCII characters a raw URI path may hold as they are.
_PLAIN = re.compile(r"[A-Za-z0-9_\-!.~'()*,;:$&+=/@]")

# Most literal prefixes of one glob; a glob with more has shorter ones.
_PREFIXES = 64


def raw_path(path: str) -> str:
    """A file path in the form of a raw URI path: other ASCII characters are
    percent-encoded, all others kept."""
    return "".join(c if ord(c) > 127 or _PLAIN.match(c) else f"%{ord(c):02X}" for c in path)


@dataclass(frozen=True)
class Glob:
    """``regex`` matches a whole raw URI path; every match starts with one of ``prefixes``,
    which are all of it if ``literal``."""

    regex: str
    prefixes: tuple
    literal: bool


def compile_glob(glob: str) -> Glob:
    """A glob over paths with ``*`` (any run of characters within one folder), ``?`` (one
    character), ``[a-z]`` and ``[^a-z]`` or ``[!a-z]`` (one of, none of), ``{one,two}`` (one
    of these patterns, nested ones too) and ``\\`` before a character that is meant as it
    is. No wildcard matches ``/``; an alternative in braces may hold one."""
    regex, prefixes, literal, rest = _sequence(glob, 0, "")
    if rest < len(glob):
        raise ValueError(f"unmatched }} in glob: {glob}")
    return Glob(regex, tuple(sorted(set(prefixes))), literal)


def glob_to_regex(glob: str) -> str:
    """Regular expression for a glob, to match a whole raw URI path."""
    return compile_glob(glob).regex


def _sequence(glob, at, ends):
    """regex, prefixes, whether these are whole, and the place of the first of ``ends``."""
    regex, prefixes, literal = "", [""], True
    while at < len(glob) and glob[at] not in ends:
        c = glob[at]
        if c == "{":
            part, heads, whole, at = _alternatives(glob, at)
        elif c == "}":
            break
        elif c in "*?[":
            heads, whole = [""], False
            part, at = _one_of(glob, at) if c == "[" else ({"*": _RUN, "?": _ONE}[c], at + 1)
        else:
            if c == "\\":
                at += 1
                if at == len(glob):
                    raise ValueError(f"nothing after the last \\ in glob: {glob}")
            part, heads, whole, at = re.escape(raw_path(glob[at])), [raw_path(glob[at])], True, at + 1
        regex += part
        if literal:
            if len(prefixes) * len(heads) <= _PREFIXES:
                prefixes = [p + h for p in prefixes for h in heads]
            else:
                whole = False
            literal = whole
    return regex, prefixes, literal, at


def _alternatives(glob, at):
    regexes, heads, whole = [], [], True
    while True:
        regex, some, literal, end = _sequence(glob, at + 1, ",}")
        if end == len(glob):
            raise ValueError(f"unclosed {{ in glob: {glob}")
        regexes.append(regex)
        heads += some
        whole = whole and literal
        if glob[end] == "}":
            return f"(?:{'|'.join(regexes)})", heads, whole, end + 1
        at = end


def _one_of(glob, at):
    """Regex of a class, and the place behind it. A ``]`` that comes first is one of it."""
    at += 1
    none_of = glob[at : at + 1] in ("^", "!")
    at += none_of
    spans = []
    while True:
        if at >= len(glob):
            raise ValueError(f"unclosed [ in glob: {glob}")
        if glob[at] == "]" and spans:
            break
        low, at = _member(glob, at)
        high = low
        if glob[at : at + 1] == "-" and glob[at + 1 : at + 2] not in ("]", ""):
            high, at = _member(glob, at + 1)
            if high < low:
                raise ValueError(f"range {low}-{high} of a class runs backwards in glob: {glob}")
        spans.append((low, high))
    members = "".join(re.escape(a) if a == b else f"{re.escape(a)}-{re.escape(b)}" for a, b in spans)
    # ASCII characters that stand percent-encoded in a raw path.
    codes = {n for a, b in spans for n in range(ord(a), min(ord(b), 127) + 1)}
    encoded = sorted(f"%{n:02X}" for n in codes if not _PLAIN.match(chr(n)))
    # A % in a path starts an encoded character, it is none itself.
    either = "|".join([f"(?!%)[{members}]", *encoded])
    look = "(?!" if none_of else "(?="
    return f"{look}(?:{either})){_ONE}", at + 1


def _member(glob, at):
    if glob[at] == "\\":
        at += 1
        if at == len(glob):
            raise ValueError(f"nothing after the last \\ in glob: {glob}")
    return glob[at], at + 1
