"""strobe: data-acquisition captures and device configuration on Spark.

Subpackages:
  sources    -- capture archives (format, encode/decode, frame index, Data Source), state files
  operators  -- calibration, reductions, sinks, packed tables, state, transcripts, catalogue, time,
                and the skew-safe ordered scan they share
  functions  -- column and frame helpers
  streaming  -- Structured Streaming reassembly, change feeds, windowed reductions, capture job
  plans      -- registered check queries over the given tables, with their DuckDB oracles
"""
