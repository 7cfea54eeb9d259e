"""lintel: Spark-native review of table quality.

Entry points:

* ``lintel.session.build_session`` - a session with the settings the plans rely on;
* ``lintel.plans.engine.RuleEngine(rules, **options).issues(df)`` - all rules in one plan;
* ``lintel.plans.review.review(df, rules=None)`` / ``Review`` - clinical check or
  rule pack (auto-selected by domain), severity, messages, summaries, ``write(dir)``;
* ``lintel.operators.profile.profile(df)``, ``operators.domain.domain_scores(df)``,
  ``operators.recommend.recommend_rules(df)`` - profiling and recommendations;
* ``lintel.packs`` - the five rule packs;
* ``lintel.sources.io`` - typed ingest by header name, conformance, writes;
* ``lintel.streaming.review_stream`` - row-local rules on a streaming DataFrame.
"""
