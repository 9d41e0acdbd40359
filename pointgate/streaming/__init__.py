"""The gate on Structured Streaming: the same operators, a keyed state for spikes, two outputs per micro-batch."""
