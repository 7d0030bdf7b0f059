from changefeed.functions.columns import (
    any_of,
    instant,
    is_blank,
    json_string,
    micros,
    once,
    variant_text,
)

__all__ = ["any_of", "instant", "is_blank", "json_string", "micros", "once", "variant_text"]
