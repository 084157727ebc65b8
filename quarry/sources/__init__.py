"""Readers: text lines, word lists, JSON lines, and the migration inputs
(item sizes, transition weights, packs)."""
