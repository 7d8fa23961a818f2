"""Brute-force counterparts in plain Python."""

import re

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return words((text or "").translate(LOWER))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def windows(items, n):
    return [tuple(items[i : i + n]) for i in range(len(items) - n + 1)]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
