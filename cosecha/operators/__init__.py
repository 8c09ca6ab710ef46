"""DataFrame -> DataFrame operators.

relational  projections, filters, joins, ordering, unions
aggregate   grouped stats, first-non-null, long-to-wide pivot, value counts
quantile    exact distributed quantiles, quantile edges and bins (qcut)
survey      prevalence, conditional counts, summaries, completeness, inventory
stats       correlation, OLS + what-if, Welch t-test, box summaries, densities
fuzzy       best-match join on string similarity (difflib or Levenshtein)
"""
