"""Writers: corpus text, frequency tables, samples, metadata and the split report."""
