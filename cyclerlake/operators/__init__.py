"""Row-set operators: unions, the auxiliary join, step features, reports."""
