from baitline.schemas import EMAIL


def email(spark, *rows):
    """Emails from partial dicts."""
    names = [f.name for f in EMAIL.fields]
    filled = []
    for i, row in enumerate(rows):
        base = {"email_id": str(i), "sender_email": "a@b.org", "sender_name": None, "subject": "",
                "body_text": "", "urls": [], "attachments": [], "page_source": None}
        filled.append(tuple({**base, **row}[n] for n in names))
    return spark.createDataFrame(filled, EMAIL)


def file(name, extension=None):
    return (name, name.rsplit(".", 1)[-1] if extension is None else extension, 1.0,
            "application/octet-stream")


def by_id(df, column, key="email_id"):
    return {r[key]: r[column] for r in df.select(key, column).collect()}
