"""DataFrame operators: conform, dedup, latest, counts, resolve, profiles, match, merge, enrich, set ops."""
