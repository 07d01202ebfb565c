"""DataFrame operators: newest or best row per key, merges, windows, flattening, bridges, spells, identity, queues."""
