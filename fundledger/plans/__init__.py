"""Layer products: bronze to silver, silver to gold, and profiles."""
