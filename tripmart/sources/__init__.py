"""Reading landed files and lookups; namespaces of the layers."""
