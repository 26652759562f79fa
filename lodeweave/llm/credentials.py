"""Credentials in source text and configuration: find the places, redact them in place.

A text is read line by line as configuration: every literal or bare value gets the
key it is assigned to (attribute, call argument, map entry, flag, environment line,
XML property, SQL setting) and, where that key says nothing, the key path of the
enclosing block. A value is a credential when the words of its key are sensitive
and its shape is that of a secret, when its own shape names an issuer, when it is
the password of a login (URL, netrc, -u, prose), or when it opens a private key
block, which goes up to its END line or as far as key text goes. References to variables, vaults or files, sample words, public keys,
certificates, checksums and ids are none. Every find carries byte offsets into the
UTF-8 text, and redaction splices the original bytes, so all else stays as it was.

Work is one pass over the rows in Arrow batches, without a shuffle but for the
final distinct; a text is held one at a time, whatever its length. Null and empty
texts give no rows, repeated rows of one key count once, a null key is skipped,
other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.session import read

MARK = b"[REDACTED]"


class Find(NamedTuple):
    line: int  # from 1
    start: int  # characters in the text
    end: int
    path: str
    kind: str


# fixed words: what makes a key sensitive, and what makes it harmless again
SENSITIVE = {"password", "passwd", "passwort", "pwd", "pw", "pass", "passphrase", "passcode", "secret", "token", "apikey", "bearer", "authorization", "kennwort", "contrasena", "clave", "pem", "credential", "credentials", "pgpassword", "accesstoken", "licensekey", "secretkey", "privatekey", "authkey", "dbpass", "dbpassword"}
KEY_OF = {"api", "secret", "access", "deploy", "signing", "sign", "license", "private", "encryption", "encrypt", "auth", "salt", "hmac", "master", "service", "account", "webhook", "client", "app", "admin", "storage", "session", "jwt", "crypt", "cipher", "aes"}
HARMLESS = {"field", "label", "length", "len", "min", "max", "ttl", "type", "name", "pub", "public", "primary", "foreign", "count", "limit", "policy", "hint", "url", "uri", "path", "file", "expiry", "expires", "format", "prompt", "id", "column", "regex", "pattern", "rule", "rules", "title", "help", "text", "placeholder", "size", "strength", "timeout", "age", "rotation", "version", "index"}
GLUE = {"value", "string", "from", "str", "r", "b", "f", "u", "br", "rb", "final", "static", "const", "char", "let", "var", "new", "private", "public", "protected", "export", "k", "s", "values", "default", "data", "content", "to", "val", "l", "literal", "text", "auto", "mut"}
SAMPLE = {"example", "dummy", "todo", "placeholder", "changeme", "change", "changeit", "sample", "test", "testing", "fake", "foo", "bar", "foobar", "none", "null", "nil", "undefined", "secret", "password", "passwd", "token", "redacted", "your", "here", "fixme", "tbd", "default", "empty", "insert", "replace", "me", "my", "key", "api", "the", "true", "false", "xxx", "set", "in", "vault", "string", "value", "unset", "masked", "hidden", "removed", "not", "a", "real", "goes", "this"}

ISSUED = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|[sr]k_live_[A-Za-z0-9]{16,}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_\w{22,}|glpat-[\w-]{16,}"
    r"|xox[abeoprs]-\d+-[\w-]{10,}|AIza[\w-]{35}|npm_[A-Za-z0-9]{36}|SG\.[\w-]{16,}\.[\w-]{16,}|hf_[A-Za-z0-9]{30,}"
    r"|eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,})"
)
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
URL = re.compile(r"\b[a-z][a-z0-9+.\-]*://([^\s:/@\"'`<>]*):([^\s\"'`<>]*?)@(?=[\w\[])")
LOGIN = (
    re.compile(r"(?:^|\s)(?:-u|--user(?:name)?)[ =]['\"]?[\w.@\-]+:(\S+?)['\"]?(?=\s|$)"),
    re.compile(r"\blogin\s+\S+\s+password\s+(\S+)"),
    re.compile(r"(?i)\b(?:password|identified by)\s+'([^']+)'"),
    re.compile(r"(?:[:,]\s|\bis\s|\buse\s|\bwith\s|\bas\s|^)[A-Za-z][\w.@\-]*\s+/\s+(\S{5,})\s*$"),
)
PROSE = re.compile(r"(?i)\b([\w\-]*(?:key|token|secret|password|passwd|passphrase|pwd|pass|kennwort|pw|bearer))\s+(?:was|is|are|ist|est|es)\s+[\"'`]?(\S{8,}?)[\"'`]?[.,;]?\s*$")
QUERY = re.compile(r"(?i)[?&;](?:auth|sig|signature|key|token|access_token|auth_token|api_?key|secret|client_secret|password|passwd|pwd)=([^&\s\"'`<>;]+)")
BASIC = re.compile(r"(?i)\bbasic\s+([A-Za-z0-9+/]{8,}={0,2})")
SCHEME = re.compile(r"(?i)^(?:bearer|token|basic|apikey|digest)\s+")
LITERAL = re.compile(r"\"((?:[^\"\\]|\\.)*)\"|'((?:[^'\\]|\\.)*)'|`([^`]*)`")
JOINT = re.compile(r"\s*(?:\+|\.\.?|\|\||&|\\)?\s*$")
WORD = re.compile(r"[A-Za-z_$][\w$\-]*")
BARE = re.compile(
    r"(?:^|[\s{,;\[(?&<])(?:--?)?([A-Za-z_][\w.\-]*)(?:\s*(?::=|\|\|=|\?=|=|:)\s*|\s+)([^\s\"'`,;<>(){}\[\]&][^\s\"'`,;<>(){}&]*)(?=\s*(?:[,;})\]&\"'`<]|\s[#/]|$|\s))"
)
SETTER = re.compile(r"(?:^|\s)(?:ENV|export|set|setenv|#define|ARG|--[\w\-]+)\s")
# a line without any of these cannot hold a find; the first group is looked for in lower case
CUES_LOW = ("pass", "pw", "secret", "token", "key", "bearer", "auth", "kennwort", "contrase", "clave", "pem", "credential", "mot_de", "motde", "mot-de", "login", "--user", " -u ", "identified", "basic ", " / ", "sig=", "signature=")
CUES = ("AKIA", "ASIA", "k_live_", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "xox", "AIza", "npm_", "hf_", "eyJ", "SG.", "@")


def lower_in_place(text: str) -> str:
    """Lower case at the same positions: a letter whose lower case is longer stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in text))


def cue_positions(text: str) -> list[int]:
    out = []
    for where, cues in ((lower_in_place(text), CUES_LOW), (text, CUES)):
        for cue in cues:
            at = where.find(cue)
            while at >= 0:
                if cue == "pass" and where.startswith(("iv", "es", "ed", "ing", "age"), at + 4):
                    at = where.find(cue, at + 4)
                    continue
                out.append(at)
                at = where.find("\n", at)  # one hit a line is enough
                at = where.find(cue, at) if at >= 0 else -1
    return out


REFERENCE = re.compile(
    r"\$\{|\$\(|\{\{|@@|^%[\w]+%$|^<.*>$|^\$\w+$|^(?:env|vault|file|secret|ref|ssm|arn|sops|param|kms|op)[:/]|^(?:process\.env|os\.environ|os\.getenv|getenv|System\.getenv|config|settings|vault|secrets|env)\b[.\[(]|^/(?:run|etc|var|home|opt|mnt|secrets)/|^__\w+__$|^#\{|^\[[A-Z_]+\]$"
)
PUBLIC = re.compile(r"^(?:ssh-(?:ed25519|rsa|dss)|ecdsa-|sha\d+[-:]|md5:|data:|-----BEGIN (?:CERTIFICATE|PUBLIC|RSA PUBLIC))")
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
DIFF = re.compile(r"^(?:<\|fim_\w+\|>)?(?:[+ ]|-(?!----(?:BEGIN|END) ))?")


def key_words(key: str) -> list[str]:
    out = []
    for part in re.split(r"[^A-Za-z0-9]+", key):
        out += [w.lower() for w in CAMEL.findall(part)] if not part.isupper() else [part.lower()]
    return out


def is_sensitive(key: str) -> bool:
    """The words of the key say password, token, secret or key of something, and none says it is about one."""
    words = key_words(key)
    while words and words[-1] in ("b", "64", "b64", "base64", "hex", "enc", "encoded", "header", "value"):
        words.pop()
    words = [w for w in words if not w.isdigit()]
    if not words or set(words) & HARMLESS:
        return False
    joined = "".join(words)
    if joined.endswith("pass") and not joined.endswith(("compass", "bypass", "trespass", "overpass")):
        return True
    if set(words) & SENSITIVE or joined in SENSITIVE or joined.endswith(("motdepasse", "password", "passwd", "passphrase", "secret", "token", "apikey", "accesskey", "secretkey", "privatekey", "deploykey", "signingkey", "licensekey")):
        return "tokens" not in words
    if words[-1] == "key":
        return any(w in KEY_OF for w in words[:-1])
    if words[-1] == "auth":
        return True
    return False


def is_reference(value: str) -> bool:
    return bool(REFERENCE.search(value))


def is_sample(value: str) -> bool:
    low = value.lower().strip("<>[](){}*. ")
    if len(set(low.replace("-", "").replace("_", ""))) <= 2:
        return True
    words = re.findall(r"[a-z]+", low)
    return not re.search(r"\d{2}", low) and all(w in SAMPLE or len(set(w)) == 1 for w in words)


def is_secret(value: str, key_known: bool = True) -> bool:
    """The shape of a secret: long enough, no reference, no sample words, not one plain word or identifier."""
    value = SCHEME.sub("", value)
    if len(value) < 5 or " " in value.strip() or is_reference(value) or PUBLIC.search(value) or is_sample(value):
        return False
    kinds = sum(bool(re.search(p, value)) for p in (r"[a-z]", r"[A-Z]", r"\d", r"[^\w\s]"))
    if re.fullmatch(r"[\d.,:]+[a-z]?", value) or re.fullmatch(r"https?://\S+", value) or "://" in value:
        return False
    if re.fullmatch(r"[a-z]+(?:[_.][a-z]+)+|[a-z]+(?:[A-Z][a-z]+)*|(?:[A-Z][a-z]+)+|[A-Z]+(?:_[A-Z]+)*", value):
        return False
    if re.search(r"\d", value):
        return kinds >= 2
    return key_known and (kinds >= 3 or (kinds == 2 and len(value) >= 8 and bool(re.search(r"[A-Z]", value)) and bool(re.search(r"[a-z]", value))) or value.count("-") >= 2)


def decoded_login(value: str) -> bool:
    try:
        text = base64.b64decode(value, validate=True).decode("utf-8")
    except (binascii.Error, ValueError):
        return False
    user, colon, password = text.partition(":")
    return bool(colon) and password.isprintable() and len(password) >= 4 and not is_reference(password) and not is_sample(password)


def decoded_secret(value: str) -> bool | None:
    """Whether a base64 or hex value hides a secret; None when it decodes to no text."""
    for decode in (lambda v: base64.b64decode(v, validate=True), bytes.fromhex):
        try:
            text = decode(value).decode("utf-8")
        except (binascii.Error, ValueError):
            continue
        if len(text) >= 4 and text.isprintable():
            return not is_reference(text) and not is_sample(text)
    return None


def _key_before(prefix: str) -> str:
    for word in reversed(WORD.findall(prefix)):
        if word.lower() not in GLUE:
            return word
    return ""


def values_of(line: str) -> Iterator[tuple[str, str, int, int]]:
    """(key, value, start, end) of the literals and bare values of a line; split literals are joined."""
    literals = [(m.group(1) or m.group(2) or m.group(3) or "", m.start() + 1, m.end() - 1) for m in LITERAL.finditer(line)]
    i = 0
    while i < len(literals):
        value, start, end = literals[i]
        j = i + 1
        while j < len(literals) and re.fullmatch(r"\s*(?:\+|\.\.?|\|\||&|\s)\s*(?:r|b|f|u)?", line[end + 1 : literals[j][1] - 1]):
            value, end, j = value + literals[j][0], literals[j][2], j + 1
        yield _key_before(line[: start - 1]), value, start, end
        if re.match(r"--?[A-Za-z][\w\-]*=", value) or ("=" in value and "?" in value):
            yield from ((k, v, start + s, start + e) for k, v, s, e in bare_values(value))
        i = j
    for k, v, s, e in bare_values(line):
        if not any(a <= s < b for _, a, b in literals):
            yield k, v, s, e


def bare_values(line: str) -> Iterator[tuple[str, str, int, int]]:
    at = 0
    setter = bool(SETTER.search(" " + line))
    while m := BARE.search(line, at):
        gap = line[m.end(1) : m.start(2)]
        if gap.strip() or setter:
            yield m.group(1), m.group(2), m.start(2), m.end(2)
        at = m.start(2) - 1 if not gap.strip() else max(m.end(2), m.start(2) + 1)


OPENS = re.compile(r"^(\s*)[\"']?([A-Za-z_][\w.\-]*)[\"']?\s*[:=]\s*(?:[|>][+-]?|\{|\[|\()?\s*$")
SECTION = re.compile(r"^\s*\[{1,2}\s*[\"']?([A-Za-z_][\w.\- :\"']*?)[\"']?\s*\]{1,2}\s*$")
TRIPLE = re.compile(r"([A-Za-z_][\w.\-]*)\s*[:=]\s*[rbfuRBFU]?(?:\"\"\"|\'\'\')\s*\\?\s*$")
ELEMENT = re.compile(r"<([A-Za-z_][\w.:\-]*)(\s[^<>]*)?>\s*([^<>]*?)\s*(?:</\1\s*>|$)")
ATTRIBUTE = re.compile(r"\b(?:key|name|id)\s*=\s*[\"']([^\"']+)[\"']", re.IGNORECASE)
ENTRIES = {"entry", "property", "setting", "param", "parameter", "add", "string", "item", "value", "variable", "var", "option", "field", "prop", "env"}


def key_paths(lines: list[str], wanted: set[int]) -> dict[int, str]:
    """Line -> the keys of the blocks around it, outermost first, by indentation and section; one pass down the text."""
    out: dict[int, str] = {}
    section, stack = "", []
    for i in range(max(wanted, default=-1) + 1):
        body = lines[i][DIFF.match(lines[i]).end() :]
        if not body.strip():
            continue
        column = len(body) - len(body.lstrip())
        while stack and stack[-1][0] >= column:
            stack.pop()
        if i in wanted:
            out[i] = ".".join(k for k in (section, *(k for _, k in stack)) if k)
        if m := SECTION.match(body):
            section, stack = m.group(1), []
        else:
            m = OPENS.match(body)
            stack.append((column, m.group(2) if m else ""))
    return out


def element_values(line: str) -> Iterator[tuple[str, str, int, int]]:
    """(key, value, start, end) of the XML elements of a line; an entry is named by its attribute."""
    for m in ELEMENT.finditer(line):
        named = ATTRIBUTE.search(m.group(2) or "")
        key = named.group(1) if named and m.group(1).lower() in ENTRIES else m.group(1)
        if m.group(3):
            yield key, m.group(3), m.start(3), m.end(3)


NEUTRAL = {"value", "val", "data", "content", "default", "literal", "string", "plain", "plaintext", "raw", "current"}
POINTS = {"ref", "refs", "from"}  # a block of such a key says where the secret lies
NAMED = re.compile(r"^[\s\-]*[\"']?(?:name|key|variable|setting)[\"']?\s*[:=]\s*[\"']?([A-Za-z_][\w.\-]*)[\"']?\s*,?\s*$", re.IGNORECASE)
ITEM = re.compile(r"^\s*-(?:\s+|$)")


def is_neutral(key: str) -> bool:
    return all(w in NEUTRAL for w in key_words(key))


def _place(line: str, diff: bool) -> tuple[int, bool, str]:
    """Column of the content, whether it is an item of a list, and the content; a diff's mark counts as none."""
    body = line[DIFF.match(line).end() :] if diff else line
    m = ITEM.match(body)
    content = body[m.end() :] if m else body.lstrip()
    return len(body) - len(content), bool(m), content


def section_lines(lines: list[str], i: int, diff: bool) -> Iterator[int]:
    """Lines of the section that opens in line i, up to the next one."""
    for j in range(i + 1, len(lines)):
        content = _place(lines[j], diff)[2]
        if SECTION.match(content) or lines[j].startswith(("@@ ", "diff --git ")):
            return
        if content.strip():
            yield j


def block_lines(lines: list[str], i: int, diff: bool) -> Iterator[int]:
    """Lines of the block that opens in line i, by bracket or indentation, but those under a key that is about a secret."""
    depth, outer = 0, []
    bracket = lines[i].rstrip().endswith(("{", "[", "("))
    base = _place(lines[i], diff)[0]
    for j in range(i, len(lines)):
        line = lines[j]
        if j > i:
            column, item, content = _place(line, diff)
            if not content.strip():
                continue
            start = column - (2 if item else 0)
            if line.startswith(("@@ ", "diff --git ")) or start < base or (not bracket and start == base and not item):
                return
            while outer and outer[-1][0] >= column:
                outer.pop()
            if m := OPENS.match(content):
                outer.append((column, m.group(2)))
            if not any(set(key_words(k)) & (HARMLESS | POINTS) for _, k in outer):
                yield j
        if bracket:
            bare = LITERAL.sub("", line)
            depth += sum(bare.count(c) for c in "{[(") - sum(bare.count(c) for c in "}])")
            if depth <= 0:
                return


def sibling_lines(lines: list[str], i: int, diff: bool) -> Iterator[int]:
    """Lines of the map entry around line i that stand at the same column."""
    column, first, _ = _place(lines[i], diff)
    for step in (1,) if first else (1, -1):
        j = i + step
        while 0 <= j < len(lines) and not lines[j].startswith(("@@ ", "diff --git ")):
            at, item, content = _place(lines[j], diff)
            if not content.strip() or at < column or (item and step > 0 and at == column):
                break
            if at == column:
                yield j
                if item or content[0] in "{}[]":
                    break
            j += step


def inherited_keys(lines: list[str], hits: set[int]) -> dict[int, tuple[str, bool]]:
    """Line -> the sensitive key its neutral keys stand for, and whether that is a name beside it and not the block's."""
    out: dict[int, tuple[str, bool]] = {}
    diff = any(x.startswith(("@@ ", "diff --git ")) for x in lines)
    for i in sorted(hits):
        diff = diff or lines[i].startswith("+")
        content = _place(lines[i], diff)[2]
        if (m := OPENS.match(content)) and is_sensitive(m.group(2)) and not set(key_words(m.group(2))) & POINTS:
            out |= {j: (m.group(2), False) for j in block_lines(lines, i, diff)}
        elif (m := SECTION.match(content)) and is_sensitive(m.group(1)) and not set(key_words(m.group(1))) & POINTS:
            out |= {j: (m.group(1), False) for j in section_lines(lines, i, diff)}
        elif (m := NAMED.match(content)) and is_sensitive(m.group(1)):
            out |= {j: (m.group(1), True) for j in sibling_lines(lines, i, diff)}
    return out


KEY_END = re.compile(r"-----END [A-Z0-9 ]*-----")
KEY_LINE = re.compile(r"^[\s#/*;\"'+\-]*([A-Za-z0-9+/=]+)(?:\\[nr])*[\"'\s+,;\\]*$")
KEY_HEADER = re.compile(r"^[\s#/*;\"'+\-]*(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset): ")
KEY_TEXT = re.compile(r"(?:\\[nr]|[A-Za-z0-9+/=\s])*")
COMMENT = re.compile(r"^[\s#/*;\"']*")
LINE_TAIL = re.compile(r"(?:\\[nr])*[\"'\s+,;\\]*$")


def private_key(lines: list[str], i: int, line: str) -> tuple[int, int, int] | None:
    """(start, last line, end in it) of a private key that opens in this line, when key text follows in it or below it.

    The key goes up to its END line; where none follows, it goes as far as lines are key text, of which only the last is short.
    """
    if not (m := PEM.search(line)):
        return None
    if close := KEY_END.search(line, m.end()):
        return m.start(), i, close.end()
    rest = KEY_TEXT.match(line, m.end())
    if len(rest.group().replace("\\n", "").strip()) >= 16:
        return m.start(), i, m.end() + len(rest.group().rstrip())
    last, longest = i, 0
    for j in range(i + 1, len(lines)):
        body = lines[j][DIFF.match(lines[j]).end() :]
        if (close := KEY_END.search(body)) and last > i:
            return m.start(), j, close.end()
        if longest == 0 and (KEY_HEADER.match(body) or (not COMMENT.sub("", body) and last > i) or (j == i + 1 and lines[j].startswith("<|fim") and not body.strip())):
            last = j
            continue
        text = KEY_LINE.match(body)
        if not text or (longest == 0 and len(text.group(1)) < 16):
            break
        last = j
        if len(text.group(1)) < longest:
            after = lines[j + 1] if j + 1 < len(lines) else ""
            if close := KEY_END.search(after):
                return m.start(), j + 1, close.end() - DIFF.match(after).end()
            break
        longest = len(text.group(1))
    if last == i:
        return None
    return m.start(), last, len(lines[last]) - DIFF.match(lines[last]).end()


def line_spans(lines: list[str], i: int, line: str, inherited: tuple[str, bool] = ("", False)) -> list[tuple[int, int, str, str]]:
    """(start, end, key, kind) of the credentials in one line; a neutral key stands for the inherited one."""
    spans: list[tuple[int, int, str, str]] = []
    spans += [(m.start(), m.end(), "", "issued") for m in ISSUED.finditer(line) if len(set(m.group()[-14:])) > 5]
    if "://" in line:
        for m in URL.finditer(line):
            if m.group(2) and not is_reference(m.group(2)) and not re.match(r"^[\$%{<]|.*[}>%]$", m.group(2)) and not is_sample(m.group(2)):
                spans.append((m.start(2), m.end(2), "url", "login"))
        spans += [(m.start(1), m.end(1), "query", "value") for m in QUERY.finditer(line) if is_secret(m.group(1))]
    for pattern in LOGIN:
        spans += [(m.start(1), m.end(1), "login", "login") for m in pattern.finditer(line) if is_secret(m.group(1))]
    spans += [(m.start(1), m.end(1), "authorization", "login") for m in BASIC.finditer(line) if decoded_login(m.group(1))]
    spans += [(m.start(2), m.end(2), m.group(1), "value") for m in PROSE.finditer(line) if is_secret(m.group(2), False)]
    values = values_of(line)
    if "<" in line and ">" in line:
        values = chain(element_values(line), values)
    for key, value, start, end in values:
        if inherited[0] and is_neutral(key) and not re.match(r"[\"'`]\s*:", line[end:]):
            meant, key = inherited[0], f"{inherited[0]}.{key}".rstrip(".") if inherited[1] else key
        elif is_sensitive(key):
            meant = key
        else:
            continue
        encoded = decoded_secret(SCHEME.sub("", value)) if re.search(r"(?i)b64|base64|hex|enc", meant) else None
        if encoded or (encoded is None and is_secret(value)):
            spans.append((start, end, key, "value"))
    return spans


def scan(text: str) -> list[Find]:
    """All credentials of a text, by place."""
    cues = cue_positions(text)
    if not cues:
        return []
    lines = text.split("\n")
    starts = list(accumulate((len(x) + 1 for x in lines), initial=0))
    hits = {bisect_right(starts, c) - 1 for c in cues}
    below: dict[int, str] = {}  # a value may stand in the line below its key
    for i in hits:
        body = lines[i][DIFF.match(lines[i]).end() :]
        key = ""
        if body.rstrip().endswith((":", "=", "|", ">", "|-", ">-")) and (m := OPENS.match(body)):
            key = m.group(2)
        elif m := TRIPLE.search(body):
            key = m.group(1)
        if not key and ">" in body and (m := ELEMENT.search(body)) and not m.group(3) and body.rstrip().endswith(">"):
            named = ATTRIBUTE.search(m.group(2) or "")
            key = named.group(1) if named and m.group(1).lower() in ENTRIES else m.group(1)
        if key and i + 1 < len(lines) and is_sensitive(key):
            below[i + 1] = key
    inherited = inherited_keys(lines, hits)
    found: list[tuple[int, int, int, str, str]] = []
    inside = -1  # last line of a key block
    for i in sorted(hits | below.keys() | inherited.keys()):
        if i <= inside:
            continue
        cut = DIFF.match(lines[i]).end()
        line = lines[i][cut:]
        spans = line_spans(lines, i, line, inherited.get(i, ("", False)))
        if "PRIVATE KEY" in line and (block := private_key(lines, i, line)):
            start, inside, end = block
            found.append((i, starts[i] + cut + start, starts[inside] + DIFF.match(lines[inside]).end() + end, "pem", "private key"))
            spans = [s for s in spans if s[1] <= start or (inside == i and s[0] >= end)]
        elif not spans and i in below and len(line.split()) == 1 and not line.rstrip().endswith(":") and is_secret(value := line.strip().strip("\"'`,;")):
            at = line.index(value)
            spans = [(at, at + len(value), below[i], "value")]
        elif not spans and i in inherited and not inherited[i][1] and (m := ITEM.match(lines[i]) or ITEM.match(line)) and len(rest := m.string[m.end() :].split()) == 1 and not rest[0].endswith(":") and is_secret(value := rest[0].strip("\"'`,;")):
            at = m.string.index(value, m.end()) - (cut if m.string is lines[i] else 0)
            spans = [(at, at + len(value), "", "value")]
        found += [(i, starts[i] + cut + start, starts[i] + cut + end, key, kind) for start, end, key, kind in spans]
    paths = key_paths(lines, {i for i, *_ in found})
    full = lambda above, key: above if key and (above == key or above.endswith(f".{key}")) else f"{above}.{key}".strip(".")
    finds = {Find(i + 1, start, end, full(paths.get(i, ""), key), kind) for i, start, end, key, kind in found}
    return sorted(finds, key=lambda f: (f.start, -f.end))


def splices(text: str, finds: list[Find]) -> list[tuple[int, int]]:
    """The spans to replace, by place and without overlap; a block of several lines is replaced line by line, marks of a diff and comments stay."""
    out: list[tuple[int, int]] = []
    for f in finds:
        at = f.start
        while at < f.end:
            stop = text.find("\n", at, f.end)
            stop = f.end if stop < 0 else stop
            start = at
            if at > f.start:
                start += DIFF.match(text[at:stop]).end()
                start += len(COMMENT.match(text[start:stop]).group())
            start = max(start, out[-1][1] if out else 0)
            end = stop if stop == f.end else start + LINE_TAIL.search(text[start:stop]).start()
            if start < end:
                out.append((start, end))
            at = stop + 1
    return out


def redact(text: str) -> str:
    """The text with every credential replaced and every other byte unchanged; the number of lines stays."""
    data, out, at, read = text.encode("utf-8"), [], 0, 0
    for start, end in splices(text, scan(text)):
        first = at + len(text[read:start].encode("utf-8"))
        out += [data[at:first], MARK]
        at, read = first + len(text[start:end].encode("utf-8")), end
    return b"".join([*out, data[at:]]).decode("utf-8")


# ---- Spark -----------------------------------------------------------------------------------


def _scan_batches(batches):
    for batch in batches:
        table, key, text = (batch.column(i).to_pylist() for i in range(3))
        rows = [(t, k, f.line, len(x[: f.start].encode()), len(x[: f.end].encode()), f.path, f.kind) for t, k, x in zip(table, key, text) if x for f in scan(x)]
        cols = list(zip(*rows)) or [()] * 7
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["src_table", "row_key", "line_no", "byte_start", "byte_end", "key_path", "kind"])


def _redact_batches(batches):
    for batch in batches:
        table, key, text = (batch.column(i).to_pylist() for i in range(3))
        out = [(x, 0, 0, 0) if not x else _redacted(x) for x in text]
        cols = list(zip(*out)) or [()] * 4
        types = (pa.string(), pa.int32(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(list(c), t) for c, t in zip(cols, types)]], names=["src_table", "row_key", "redacted", "places", "bytes_removed", "left_over"])


def _redacted(text: str) -> tuple[str, int, int, int]:
    """(redacted text, places replaced, bytes replaced, places found again in the redacted text)."""
    places = splices(text, scan(text))
    if not places:
        return text, 0, 0, 0
    out = redact(text)
    return out, len(places), sum(len(text[a:b].encode("utf-8")) for a, b in places), len(scan(out))


def texts_of(samples: DataFrame, commits: DataFrame, pulls: DataFrame) -> DataFrame:
    """(src_table, row_key, text) of the three tables."""
    parts = [
        samples.select(F.lit("samples").alias("src_table"), F.col("sample_id").cast("string").alias("row_key"), "text"),
        commits.select(F.lit("commits").alias("src_table"), F.col("sha").alias("row_key"), F.col("diff_text").alias("text")),
        pulls.select(F.lit("pulls").alias("src_table"), F.col("pr_number").cast("string").alias("row_key"), F.col("diff_text").alias("text")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("row_key is not null and length(text) > 0")


def find_credentials(texts: DataFrame) -> DataFrame:
    """(src_table, row_key, text) -> one row per credential with line, byte offsets, key path and kind."""
    return texts.mapInArrow(_scan_batches, "src_table string, row_key string, line_no bigint, byte_start bigint, byte_end bigint, key_path string, kind string")


def redact_credentials(texts: DataFrame) -> DataFrame:
    """(src_table, row_key, text) -> (src_table, row_key, redacted, places, bytes_removed, left_over); a row out for each row in, null stays null.

    left_over counts what a second look at the redacted text still finds: none.
    """
    return texts.mapInArrow(_redact_batches, "src_table string, row_key string, redacted string, places int, bytes_removed bigint, left_over int")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = texts_of(
        read(spark, sf_dir, "samples", "sample_id", "text"),
        read(spark, sf_dir, "commits", "sha", "diff_text"),
        read(spark, sf_dir, "pulls", "pr_number", "diff_text"),
    )
    return find_credentials(texts).select("src_table", "row_key", "line_no").distinct()


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: texts, those redacted, places and bytes replaced, bytes in and out, and places a second look still finds."""
    texts = texts_of(
        read(spark, sf_dir, "samples", "sample_id", "text"),
        read(spark, sf_dir, "commits", "sha", "diff_text"),
        read(spark, sf_dir, "pulls", "pr_number", "diff_text"),
    )
    return (
        redact_credentials(texts)
        .groupBy("src_table")
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.count_if(F.col("places") > 0).alias("redacted_texts"),
            F.sum("places").alias("places"),
            F.sum("bytes_removed").alias("bytes_removed"),
            F.sum(F.octet_length("redacted")).alias("bytes_out"),
            F.sum("left_over").alias("left_over"),
        )
    )
