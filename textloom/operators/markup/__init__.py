"""Parsers of HTML and wikitext, and their conversion to Markdown."""
