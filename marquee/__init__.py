"""marquee: credits-and-ratings analytics on Spark DataFrames.

Every operator takes DataFrames plus column names and returns a DataFrame;
nothing is collected to the driver.  Batch operators live in
``marquee.operators``, their event-time streaming forms in
``marquee.streaming``, readers in ``marquee.sources``, writers in
``marquee.sinks``, column-expression helpers in ``marquee.functions`` and the
user-level products (movies table, people table, ...) in ``marquee.plans``.
"""

__version__ = "0.1.0"
