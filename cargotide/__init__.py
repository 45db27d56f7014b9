"""cargotide: shipment-demand analytics as Spark DataFrame jobs.

Raw outbound lines become a gap-free daily panel; the panel gets calendar, lunar,
lag and year-over-year features, sliding windows, forecasts, business rules and scores.
"""
