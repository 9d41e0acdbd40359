"""DataFrame -> DataFrame operators: normalising, the gate, spikes, feed decoding, limits, counts."""
