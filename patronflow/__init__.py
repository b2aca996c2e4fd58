"""patronflow: customer-lifecycle analytics as Spark DataFrame plans.

Layers
------
``sources``    entity schemas, projected scans, delimited files, report sinks
``functions``  column-level rules: null handling, dates, text rules, binning
``operators``  DataFrame-level building blocks: null-safe joins, exact
               quantiles, aggregates, reshaping
``plans``      the reports: order facts, RFM, cohorts, stages, transitions,
               channels and attribution, customer 360, lifetime value
"""
