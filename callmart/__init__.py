"""Contact-history feature mart and answer-propensity ranking on Spark DataFrames."""
