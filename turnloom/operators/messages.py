"""Message validation: role names, content, and the all-or-nothing rule for one sample."""

from __future__ import annotations

from turnloom.functions import clean_text, let, needs_raw, quoted, raw_text, typed_fields

# Accepted role names, lower case, by the role they stand for.
ROLE_NAMES = {
    "user": ("user", "human"),
    "assistant": ("assistant", "gpt", "bot", "ai", "chatgpt"),
    "system": ("system",),
}


def normalise_role(role: str) -> str:
    """Standard role of a role name in any case; NULL where the name is unknown. No trimming."""
    entries = ", ".join(
        f"{quoted(name)}, {quoted(target)}" for target, names in ROLE_NAMES.items() for name in names
    )
    table = f"map({entries})"
    # Most names are lower case already, and folding case is the dearer step.
    return f"coalesce(try_element_at({table}, {role}), try_element_at({table}, lower({role})))"


def check_messages(raw: str, contents: str) -> str:
    """Per message: the first rule it breaks (NULL if none), 1-based index, role and content.

    `contents` gives the raw JSON text of all contents. It is used only where a content is a list,
    an object or a very long integer, which a VARIANT does not hold as it was written.
    """
    read = f"""struct(m IS NULL AS foreign, m.role IS NULL OR m.content IS NULL AS incomplete,
      try_variant_get(m.role, '$', 'string') AS role_in, {typed_fields("m.content")})"""
    text = f"""CASE WHEN raws IS NOT NULL AND {needs_raw("r")} AND get(raws, at) IS NOT NULL
      THEN {let("raw", "get(raws, at)", raw_text("r", "raw"))} ELSE {clean_text("r")} END"""
    cleaned = f"""struct(r.foreign, r.incomplete, r.role_in,
      {normalise_role("r.role_in")} AS role, {text} AS content)"""
    judged = """struct(
      CASE WHEN c.foreign THEN 'not_object'
           WHEN c.incomplete THEN 'missing_key'
           WHEN c.role IS NULL THEN 'bad_role'
           WHEN c.content = '' THEN 'empty_content' END AS reason,
      i + 1 AS msg_index, c.role_in, c.role, c.content)"""
    raws = f"if(exists(seen, r -> {needs_raw('r')}), {contents}, NULL)"
    steps = let("raws", raws, f"transform(seen, (r, at) -> {cleaned})")
    return let("seen", f"transform({raw}, m -> {read})", f"transform({steps}, (c, i) -> {judged})")


# A VARIANT holds at most 128 MiB, and the JSON reader takes field names of at most 50,000
# characters. A line beyond either may be sound and still not fit.
LARGEST_LINE, LONGEST_NAME = 128 * 1024 * 1024, 50_000
_LONG_NAME = quoted(rf'"[^"]{{{LONGEST_NAME + 1},}}"\s*:')


def verdict(line: str, record: str, env: str, picked: str, checked: str) -> str:
    """Struct of shape, outcome, reason, msg_index, detail and messages for one line.

    outcome is `processed`, `error` (the line gave no messages) or `dropped` (the first bad
    message took the whole sample with it).
    """
    failure = f"""CASE
      WHEN {record} IS NULL AND octet_length({line}) >= {LARGEST_LINE} THEN 'too_large'
      WHEN {record} IS NULL AND octet_length({line}) > {LONGEST_NAME}
        AND regexp_like({line}, {_LONG_NAME}) THEN 'too_large'
      WHEN {record} IS NULL THEN 'malformed'
      WHEN {env}.known IS NULL THEN 'not_object'
      WHEN {picked}.messages IS NULL OR size({picked}.messages) = 0 THEN 'no_messages' END"""
    first_bad = f"get(filter({checked}, m -> m.reason IS NOT NULL), 0)"
    clean = f"transform({checked}, m -> struct(m.role, m.content))"
    fields = f"""struct(
      if({env}.known IS NULL, NULL, {picked}.shape) AS shape,
      CASE WHEN failed.why IS NOT NULL THEN 'error'
           WHEN failed.bad IS NOT NULL THEN 'dropped' ELSE 'processed' END AS outcome,
      coalesce(failed.why, failed.bad.reason) AS reason,
      failed.bad.msg_index AS msg_index,
      if(failed.bad.reason = 'bad_role', failed.bad.role_in, NULL) AS detail,
      if(failed.why IS NULL AND failed.bad IS NULL, {clean}, NULL) AS messages)"""
    return let("failed", f"struct({failure} AS why, {first_bad} AS bad)", fields)
