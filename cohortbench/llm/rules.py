"""The curated URL rules of the registered query (fixed values)."""

from cohortbench.llm.url_rules import Rule

URL_RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]
