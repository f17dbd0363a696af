"""DataFrame operators: normalise, score, enrich, summarise, replay, account, audit, cost."""
