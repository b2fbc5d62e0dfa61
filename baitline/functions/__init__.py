"""Column expressions: string and number in, string and number out, no Python workers."""
