"""Plan building blocks: in-plan statistics, distributed quantiles and
orderings."""
